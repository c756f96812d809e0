from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from carelake.llm import near_duplicates
from carelake.plans.session import BATCH_ROWS, small_batches, written
from llm_support import ordered, table_rows


def brute(docs, size, part, whole):
    sets = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset())
    parent, holders = list(range(len(docs))), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, own in enumerate(sets):
        common = Counter()
        for shingle in own:
            common.update(holders.get(shingle, ()))
            holders.setdefault(shingle, []).append(x)
        for y, n in common.items():
            if whole * n >= part * (len(own) + len(sets[y]) - n):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(docs):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return [(i, len(sets[x]), least.get(root(x)), i == least.get(root(x))) for x, (i, _) in enumerate(docs)]


def check(df, size, part):
    got = table_rows(near_duplicates.near_duplicates(df, size, part, 100), "doc_id", "n_shingles", "component_id", "kept")
    want = brute(table_rows(df, "doc_id", "text"), size, part, 100)
    assert ordered(got) == ordered(want)


def test_driver_documents(documents):
    check(documents, 3, 85)
    check(documents, 5, 80)


def test_a_group_of_variants_around_the_threshold(spark):
    draw = random.Random(1)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(draw.randrange(0, 6)):
            words[draw.randrange(120)] = f"x{draw.randrange(9999)}"
        rows.append((1000 - i, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)


def test_a_repeated_id_with_two_texts_that_have_near_copies(spark):
    texts = [" ".join(f"{letter}{i}" for i in range(100)) for letter in "abc"]
    rows = [(1, text) for text in texts] + [(5 + i, f"{text} more") for i, text in enumerate(texts)] + [(9, texts[0])]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)


def test_odd_rows(odd, nothing):
    rows = table_rows(near_duplicates.near_duplicates(odd), "doc_id", "n_shingles", "component_id", "kept")
    assert len(rows) == 12
    assert all(n == 0 or c is not None for i, n, c, _ in rows if i is not None)
    assert {(i, c, k) for i, n, c, k in rows if i in (5, 6)} == {(5, 5, True), (6, 5, False)}
    assert {(c, k) for i, n, c, k in rows if n == 0 and i is not None} == {(2, True), (3, True), (4, True)}
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(4)
    a = draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], draw.integers(0, 1 << 63, 100).astype(np.uint64)])
    same = (near_duplicates.signature(a) == near_duplicates.signature(b)).mean()
    assert abs(same - 900 / 1100) < 0.15


def test_texts_reach_python_in_small_batches(spark, documents, monkeypatch):
    """Of 10,000 whole texts at a time an executor of 3 GB held too many; the session's own setting stays."""
    before, seen = spark.conf.get(BATCH_ROWS), []
    monkeypatch.setattr(near_duplicates, "written", lambda df, *a: seen.append(spark.conf.get(BATCH_ROWS)) or written(df, *a))
    near_duplicates.near_duplicates(documents)
    assert seen and max(map(int, seen)) <= 512
    assert spark.conf.get(BATCH_ROWS) == before


def test_batches_are_bounded_in_rows_and_bytes(spark):
    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', IF(id < 200, 100000, 10)) AS text")
    with small_batches(spark, 512, "1m"):
        found = rows.mapInArrow(counted, "n long, size long").collect()
    assert sum(r.n for r in found) == 3000
    assert max(r.n for r in found) == 512
    assert max(r["size"] for r in found) < 2 << 20
