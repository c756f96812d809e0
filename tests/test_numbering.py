from __future__ import annotations

import random

from pyspark.sql import functions as F

from carelake.plans.numbering import in_ranges, running_total, with_position


def test_positions_follow_the_order_without_gaps(spark):
    values = random.Random(1).sample(range(10**6), 5000)
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7)
    got = {r.v: r.position for r in with_position(rows, "v").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_positions_over_text_and_several_columns(spark):
    pairs = [(i % 3, f"k{i:04d}") for i in range(300)]
    rows = spark.createDataFrame(pairs, "a int, b string")
    got = {(r.a, r.b): r.position for r in with_position(rows, "a", "b").collect()}
    assert got == {p: i + 1 for i, p in enumerate(sorted(pairs))}


def test_running_total_over_slices_of_one_key(spark):
    rng = random.Random(2)
    rows = [("x" if rng.random() < 0.7 else "y", i, rng.randint(0, 9)) for i in range(4000)]
    ranged = in_ranges(spark.createDataFrame(rows, "k string, seq bigint, q int"), "k", "seq")
    assert ranged.filter("k = 'x'").select("range_no").distinct().count() > 1
    got = running_total(ranged, ["k"], "seq", F.col("q"), "total").collect()
    sums, want = {}, {}
    for k, seq, q in rows:
        sums[k] = sums.get(k, 0) + q
        want[seq] = sums[k]
    assert {r.seq: r.total for r in got} == want
