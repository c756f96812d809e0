"""The batch decision equals deciding the commands one after the other."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.operators.dispensing import decide

SCHEMA = "hospital_id string, drug_id string, seq bigint, quantity int, stock int"


def one_by_one(commands):
    left, out = {}, {}
    for hospital, drug, seq, quantity, stock in sorted(commands, key=lambda c: c[2]):
        now = left.setdefault((hospital, drug), stock)
        if quantity <= now:
            left[hospital, drug] = now - quantity
        out[seq] = (quantity <= now, left[hospital, drug])
    return out


def run(spark, commands, fold_limit):
    rows = decide(spark.createDataFrame(commands, SCHEMA), fold_limit).collect()
    assert len(rows) == len(commands)
    return {r.seq: (r.granted, r.remaining_stock) for r in rows}


def commands_of(seed, keys, count, largest, stock):
    rng = random.Random(seed)
    stocks = [rng.randint(0, stock) for _ in range(keys)]
    seqs = rng.sample(range(count * 3), count)
    out = []
    for seq in seqs:
        key = 0 if rng.random() < 0.4 else rng.randrange(keys)  # one key holds over a third
        out.append(("H1", f"D{key}", seq, rng.randint(1, largest), stocks[key]))
    return out


@pytest.mark.parametrize("fold_limit,largest,stock", [(0, 5, 60), (0, 100, 120), (20, 5, 60), (1000, 100, 120)])
def test_fold_and_rounds_agree_with_the_loop(spark, fold_limit, largest, stock):
    commands = commands_of(fold_limit + largest, 6, 150, largest, stock)
    assert run(spark, commands, fold_limit) == one_by_one(commands)


def test_refused_command_uses_nothing(spark):
    commands = [("H1", "D1", i, q, 8) for i, q in enumerate((3, 9, 4))]
    for fold_limit in (0, 10):
        assert run(spark, commands, fold_limit) == {0: (True, 5), 1: (False, 5), 2: (True, 1)}


def test_alternating_small_and_large(spark):
    """The case in which a plain prefix rule would need one round per pair."""
    commands, left = [], 40
    for i in range(40):
        commands += [("H1", "D1", 2 * i, 1, 40), ("H1", "D1", 2 * i + 1, 40 - i, 40)]
    assert run(spark, commands, 0) == one_by_one(commands)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 40)), min_size=1, max_size=40), st.integers(0, 70))
def test_random_batches_by_rounds(spark, pairs, stock):
    commands = [("H1", f"D{key}", i, quantity, stock) for i, (key, quantity) in enumerate(pairs)]
    assert run(spark, commands, 0) == one_by_one(commands)
