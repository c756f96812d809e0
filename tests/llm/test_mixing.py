from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import mixing


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        shared = sum(weight[s] for s in order if s not in full)
        found = {s: 3.0 * sizes[s] if s in full else left * weight[s] / shared for s in order}
        over = {s for s in order if s not in full and found[s] > 3 * sizes[s]}
        if not over:
            return found
        full |= over


def sums(rows):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    return sizes, taken, target


def test_sources_meet_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mix = mixing.planned(docs, block_words=4000, shard_blocks=5)
    rows = mixing.taken(mix).collect()
    sizes, taken, target = sums(rows)
    want = targets(sizes)
    assert len(rows) == docs.count() and mix.shards > 5
    for source, value in want.items():
        assert abs(target[source] - value) < 1e-6 * max(1, value)
        assert abs(taken[source] - value) <= 0.02 * value
    assert all(r.taken <= 3 * r.size for r in rows)
    again = {(r.doc_id, r.taken) for r in mixing.taken(mixing.planned(docs, block_words=4000, shard_blocks=5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    drawn = mixing.mixed(docs, mix)
    assert drawn.columns == docs.columns
    words = F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    assert drawn.agg(F.sum(words)).first()[0] == sum(r.taken for r in rows)


def test_a_source_that_stops_at_three_times_its_size(spark):
    rows = [(i, "w " * 100, "big") for i in range(60)] + [(100 + i, "v " * 10, "a") for i in range(20)]
    mix = mixing.planned(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sizes, taken, target = sums(mixing.taken(mix).collect())
    assert target == targets(sizes) and target["a"] == 600 and taken["a"] == 600


def test_one_document_holds_most_of_a_source(spark):
    rows = [(0, "w " * 70_000, "a")] + [(i, f"v{i} " * 100, "a") for i in range(1, 301)] + [(1000 + i, "u " * 100, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for seed in (20, 21):
        mix = mixing.planned(docs, weights=(1.0, 3.0), most=10, block_words=2000, seed=seed)
        sizes, taken, target = sums(found := mixing.taken(mix).collect())
        assert sizes["a"] == 100_000 and abs(target["a"] - 27_500) < 1e-3
        assert target["a"] - 100 < taken["a"] <= target["a"]
        assert all(r.taken <= r.size for r in found if r.source == "a")
        words = mixing.mixed(docs, mix).agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
        assert words == sum(taken.values())


def test_odd_rows(odd, nothing):
    mix = mixing.planned(odd)
    rows = mixing.taken(mix).collect()
    sizes, _, target = sums(rows)
    assert len(rows) == 12 and target == targets(sizes) and None in target
    assert set(mixing.mixed(odd, mix).columns) == set(odd.columns)
    empty = mixing.planned(nothing)
    assert mixing.taken(empty).count() == 0 and mixing.mixed(nothing, empty).count() == 0


def test_the_tree_deals_every_draw_once():
    totals = np.array([17, 0, 120, 3])
    parts = [mixing.split(totals, 7, s, seed=1) for s in range(7)]
    assert (sum(own for own, _ in parts) == totals).all()
    assert all((parts[s][1] == sum((own for own, _ in parts[:s]), np.zeros(4, int))).all() for s in range(7))
    assert max(own.sum() for own, _ in parts) - min(own.sum() for own, _ in parts) <= 1
