"""Delimited text into staging: every column stays text, columns are bound by header name."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.figures import moment
from carelake.schemas import Table

CORRUPT = "corrupt_record"
SOURCE = ["stg_load_timestamp", "stg_source_file"]


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: Table,
    load_time: datetime,
    sep: str = ",",
    quoted: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Staged rows of ``table``, with the time and file they came from.

    Every file is bound to the table by its own header, so its column order does not matter and
    columns the table does not have are ignored; columns the file lacks are NULL. Files with
    the same header are one scan. Lines with too many or too few fields keep their text in
    ``corrupt_record``, and so do all lines of a file whose header names no column of the table.
    Files stay splittable unless ``multi_line`` asks for line breaks inside quotes.
    """
    options = {
        "header": True, "sep": sep, "encoding": "UTF-8", "mode": "PERMISSIVE", "columnPruning": False,
        "quote": '"' if quoted else "", "escape": '"' if quoted else "\\", "multiLine": multi_line,
    }
    origin = [moment(load_time).alias(SOURCE[0]), F.col("_metadata.file_path").alias(SOURCE[1])]

    def bound(header: str, files: list[str]) -> DataFrame:
        names = next(csv.reader([header], delimiter=sep, quoting=csv.QUOTE_MINIMAL if quoted else csv.QUOTE_NONE))
        source_of = {table.renamed.get(n.strip().lower(), n.strip().lower()): i for i, n in enumerate(names)}
        if not set(source_of) & set(table.column_names):
            lines = spark.read.text(files)
            nothing = [F.lit(None).cast("string").alias(c) for c in table.column_names]
            return lines.select(*nothing, F.col("value").alias(CORRUPT), *origin)
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        rows = spark.read.options(**options, columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(files)
        columns = [
            (F.col(f"c{source_of[c]}") if c in source_of else F.lit(None).cast("string")).alias(c)
            for c in table.column_names
        ]
        return rows.select(*columns, CORRUPT, *origin)

    given = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    while given:  # a path named twice is delivered twice
        once = list(dict.fromkeys(given))
        parts += [bound(header, files) for header, files in headers(spark, once).items()]
        for path in once:
            given.remove(path)
    if not parts:
        fields = [*table.column_names, CORRUPT]
        empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in fields]))
        return empty.select(*fields, moment(load_time).alias(SOURCE[0]), F.lit("").alias(SOURCE[1]))
    return reduce(DataFrame.unionByName, parts)


def headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """The files under ``paths`` by their first line; files without one are left out.

    Spark lists the files, as it does for any scan; of each file the start is read, whatever its size, a few files at a time.
    """
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path")
    files = sorted(r.path for r in listed.collect())  # a name per file; their contents are not read
    with ThreadPoolExecutor(16) as pool:
        lines = pool.map(lambda file: first_line(spark, file), files)
    found: dict[str, list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            found.setdefault(line.removeprefix("\ufeff"), []).append(file)
    return dict(sorted(found.items()))


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file of any file system and compression Spark reads; None for an empty file."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(settings).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def read_csv(spark: SparkSession, paths, table: Table, load_time: datetime, **options) -> DataFrame:
    return read_delimited(spark, paths, table, load_time, ",", **options)


def read_tsv(spark: SparkSession, paths, table: Table, load_time: datetime, **options) -> DataFrame:
    """Tab-separated text as the patient file uses it: no quoting."""
    return read_delimited(spark, paths, table, load_time, "\t", quoted=False, **options)


def is_corrupt(staged: DataFrame) -> Column:
    """Whether a line had the wrong number of fields.

    Spark refuses to scan text for this column alone (a count, say), so a data column is
    named beside it; none of its characters are used.
    """
    return F.length(F.concat_ws("", CORRUPT, F.left(staged.columns[0], F.lit(0)))) > 0


def readable(staged: DataFrame) -> DataFrame:
    """The rows that have the right number of fields."""
    return staged.filter(~is_corrupt(staged)).drop(CORRUPT)


def unreadable(staged: DataFrame, table: Table) -> DataFrame:
    """Quarantine rows for the lines that do not."""
    return staged.filter(is_corrupt(staged)).select(
        F.lit(table.full_name).alias("target_table"),
        F.lit(None).cast("string").alias("source_key"),
        F.array(F.lit("parse:fields")).alias("reasons"),
        F.to_json(F.struct(CORRUPT)).alias("raw_data"),
    )


def write_delimited(rows: DataFrame, path: str, sep: str = ",", quoted: bool = True, codec: str = "none") -> None:
    """Rows as text files with a header, blanks kept."""
    rows.write.options(
        header=True, compression=codec, sep=sep, quote='"' if quoted else "", escape='"', emptyValue='""' if quoted else "",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
