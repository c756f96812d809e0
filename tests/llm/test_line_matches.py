from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from carelake.llm import line_matches
from carelake.plans.session import scratch_folder
from llm_support import table_rows


def brute(docs):
    lines = []
    for i, text in docs:
        for place, line in enumerate((text or "").encode().lower().split(b"\n")):
            if line.split():
                lines.append(((i, place), frozenset(line.split())))
    lines.sort(key=lambda x: x[0])
    seen, found = [], {}
    for where, words in lines:
        found[where] = any(100 * len(words & s) >= 80 * len(words | s) for s in seen)
        if words not in seen:
            seen.append(words)
    return found


def test_variants_of_a_line(spark, monkeypatch):
    draw = random.Random(2)
    base, rows = [f"w{i}" for i in range(40)], []
    for i in range(250):
        words = list(base)
        for _ in range(draw.randrange(0, 9)):
            words[draw.randrange(40)] = f"x{draw.randrange(60)}"
        rows.append((500 - i, " ".join(words) + "\n\na b c\nthe of " + draw.choice("abcdef")))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line): r.removed for r in line_matches.repeated_lines(df).collect()}
    assert got == brute(rows)


def test_the_first_of_many_variants_is_not_open(spark, monkeypatch):
    """Only earlier lines remove a line, so heads of large groups of variants must not pull their words through the join again."""
    rows = []
    for group in range(20):
        base = [f"g{group}w{i}" for i in range(40)]
        rows += [(100 * group + i, " ".join([*base[1:], f"x{group}y{i}"])) for i in range(30)]
    rounds, first = [], line_matches.Matcher.candidates
    monkeypatch.setattr(line_matches.Matcher, "candidates", lambda *a: rounds.append(a[1]) or first(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line): r.removed for r in line_matches.repeated_lines(df).collect()}
    assert got == brute(rows)
    assert len(rounds) == 1


def test_an_open_set_that_a_far_partner_removes(spark, monkeypatch):
    """With one partner a word, sets whose closest earlier partner does not match go through the join again."""
    monkeypatch.setattr(line_matches, "PARTNERS", 1)
    draw, rows = random.Random(7), [(None, " ".join(f"w{i}" for i in range(40)))]
    for i in range(200):
        words = [f"w{i}" for i in range(40)]
        for _ in range(draw.randrange(2, 12)):
            words[draw.randrange(40)] = f"x{draw.randrange(200)}"
        rows.append((draw.randrange(50) * 1000 + i, " ".join(words) + f"\nalone{i}"))
    rounds, first = [], line_matches.Matcher.candidates
    monkeypatch.setattr(line_matches.Matcher, "candidates", lambda *a: rounds.append(a[1]) or first(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line): r.removed for r in line_matches.repeated_lines(df).collect()}
    want = brute([(-1 if i is None else i, text) for i, text in rows])
    assert {(-1 if i is None else i, place): gone for (i, place), gone in got.items()} == want
    assert len(rounds) == 2


def test_driver_documents(documents):
    got = {(r.doc_id, r.line): r.removed for r in line_matches.repeated_lines(documents).collect()}
    assert got == brute(table_rows(documents, "doc_id", "text"))


def test_odd_rows(odd, nothing):
    rows = line_matches.without_repeats(odd).collect()
    assert len(rows) == 12
    assert {(r.n_lines, r.n_removed) for r in rows if r.doc_id in (2, 3, 4)} == {(0, 0)}
    assert {r.text for r in rows if r.doc_id == 4} == {" \n\t "}
    assert {(r.doc_id, r.n_removed) for r in rows if r.doc_id in (5, 6)} == {(5, 0), (6, 1)}
    assert line_matches.without_repeats(nothing).count() == 0


def test_words_of_odd_texts():
    """Words found in the bytes of many texts at once are those of each line alone, also long ones and ones that hold zeros."""
    texts = [
        b"", b"\n\n", b"a\0 a a\0\0", b" One\ttwo\x0bONE\x0c\x1c \r\nthree  ", b"x" * 64 + b" " + b"x" * 65 + b" " + b"x" * 300, b"12345678 123456789 1234567",
        "ä Ä é\n\nlast".encode(), b"no end\n", b"y" * 64 + b"a " + b"y" * 64 + b"b",
    ]
    rank, got = np.zeros(line_matches.COUNTERS, np.uint64), {}
    for owners, places, keys, starts, sizes in line_matches.line_sets(texts, rank):
        for owner, place, start, size in zip(owners.tolist(), places.tolist(), starts.tolist(), sizes.tolist(), strict=True):
            got[owner, place] = frozenset(keys[start : start + size].tolist())
    want = {(i, j): frozenset(line.split()) for i, t in enumerate(texts) for j, line in enumerate(t.lower().split(b"\n")) if line.split()}
    assert {at: len(keys) for at, keys in got.items()} == {at: len(line) for at, line in want.items()}
    for at in want:
        for other in want:
            assert len(got[at] & got[other]) == len(want[at] & want[other])
    words = [word for text in texts for word in text.lower().split()]
    assert sum(batch.column("n").to_numpy().sum() for batch in counters(texts)) == len(words)


def counters(texts):
    batches = line_matches.counted(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])]))
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("n").flatten()], names=["n"])


def test_sets_too_large_for_the_sort_key(monkeypatch):
    """Sets beyond the sizes that entries are sorted by come in no order, and every pair is still found."""
    monkeypatch.setattr(line_matches, "SIZE_BITS", 3)
    sizes = [5, 6, 12, 9, 11, 100, 10, 90]
    at = [(77 << 3) | min(n, 7) for n in sizes]
    entries = [at, [n << 32 | 1 for n in sizes], range(len(sizes)), [0] * 8, [0] * 8, [0] * 8]
    rows = pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in entries], names=["at", "size", "set_key", "parity1", "parity2", "doc"])
    for cut in (8, 3, 1):
        pieces = [rows.slice(i, cut) for i in range(0, 8, cut)]
        found = pa.Table.from_batches(line_matches.pairs_of(iter(pieces), 80, 100, 1 << 62)).to_pylist()
        pairs = {tuple(sorted((sizes[r["u"]], sizes[r["v"]]))) for r in found}
        assert pairs == {(a, b) for a in sizes for b in sizes if a < b and 100 * a >= 80 * b}


def test_prefixes_are_stored_once(spark):
    """The lines are kept without the prefixes once the classes have them."""
    df = spark.createDataFrame([(1, "a b c\nd e f"), (2, "a b c")], "doc_id long, text string")
    rows = df.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    run = line_matches.Matcher(rows, 80, 100)
    assert run.lines.columns == ["doc_id", "text_key", "line", "set_key"]
    folders = [path.name for path in Path(scratch_folder(spark).removeprefix("file:")).iterdir()]
    assert not [name for name in folders if name.startswith("lines-sets")]
    assert run.classes.count() == 2
