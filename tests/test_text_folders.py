"""A folder of delivered files, each bound by its own header."""

from __future__ import annotations

import gzip
from datetime import datetime

from carelake.schemas import BY_NAME
from carelake.sources.text_files import headers, read_csv, readable, unreadable

AT = datetime(2025, 1, 1)


def test_files_of_one_folder_are_bound_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("hospital_id,latitude,longitude\nH1,30.1,31.1\n")
    (tmp_path / "b.csv").write_text("longitude,hospital_id,latitude\n32.2,H2,30.2\n")
    (tmp_path / "c.csv").write_text("hospital_id,latitude,longitude\nH3,30.3,31.3\n")
    (tmp_path / "d.csv").write_text("nothing,known\n1,2\n")
    table = BY_NAME["hospital"]
    assert sorted(map(len, headers(spark, str(tmp_path)).values())) == [1, 1, 2]
    staged = read_csv(spark, str(tmp_path), table, AT)
    rows = {r.hospital_id: (r.latitude, r.longitude) for r in readable(staged).collect()}
    assert rows == {"H1": ("30.1", "31.1"), "H2": ("30.2", "32.2"), "H3": ("30.3", "31.3")}
    assert unreadable(staged, table).count() == 2  # both lines of the file that cannot be bound


def test_an_empty_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv(spark, str(tmp_path), BY_NAME["hospital"], AT).count() == 0


def bytes_read(spark) -> int:
    """Bytes that the driver's and the local tasks' file systems have read so far."""
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(found.get(i).getBytesRead() for i in range(found.size()))


def test_finding_headers_reads_the_start_of_files_only(spark, tmp_path):
    read = []
    for lines in (10, 400_000):
        folder = tmp_path / str(lines)
        folder.mkdir()
        for name in ("a.csv", "b c.csv"):
            (folder / name).write_text("hospital_id,hospital_name\n" + "H1,a name of some length\n" * lines)
        before = bytes_read(spark)
        assert [len(f) for f in headers(spark, str(folder)).values()] == [2]
        read.append(bytes_read(spark) - before)
    assert read[1] <= 2 * (64 << 10)  # a buffer a file, of some 20 MB


def test_compressed_files_marks_and_names_with_blanks(spark, tmp_path):
    (tmp_path / "a file.csv.gz").write_bytes(gzip.compress("hospital_name,hospital_id\r\nFirst,H1\r\n".encode()))
    (tmp_path / "b.csv").write_bytes("﻿hospital_id,hospital_name\nH2,Zweites–Haus\n".encode())
    (tmp_path / "_ignored.csv").write_text("hospital_id\nH3\n")
    rows = readable(read_csv(spark, str(tmp_path), BY_NAME["hospital"], AT)).collect()
    assert {r.hospital_id: r.hospital_name for r in rows} == {"H1": "First", "H2": "Zweites–Haus"}
