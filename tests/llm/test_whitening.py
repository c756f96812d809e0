from __future__ import annotations

import math

import numpy as np
import pytest

from carelake.llm import whitening
from llm_support import SF

COLUMNS = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def check(df, count=4):
    got = [tuple(r) for r in whitening.whitened(df, count).select(*COLUMNS).collect()]
    rows = [(r.vec_id, [math.floor(256 * c) for c in r.embedding]) for r in df.collect()
            if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    distinct = sorted({tuple(x) for _, x in rows})
    n, width = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(width)]
    centred = np.array(distinct) - np.array([s / n for s in sums])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == len(rows) * min(count, width)
    by_id: dict = {}
    for vec_id, component, n_, deviation, white, explained, error in got:
        by_id.setdefault((vec_id, deviation), {})[component] = white
        assert n_ == n and error <= 1e-9 and explained == pytest.approx(max(e[component - 1], 0) / max(e.sum(), 1e-300), rel=1e-9, abs=1e-12)
    sign: dict = {}
    for vec_id, x in rows:
        own = by_id[vec_id, sum((n * v - s) ** 2 for v, s in zip(x, sums))]
        for c, white in own.items():
            if e[c - 1] <= 1e-9 * e[0]:
                assert white is None
                continue
            want = float((np.array(x) - np.array(sums) / n) @ q[:, c - 1] / math.sqrt(e[c - 1]))
            if abs(want) > 1e-3:
                sign.setdefault(c, math.copysign(1, want * white))
            assert white == pytest.approx(sign.get(c, 1) * want, abs=1e-8) or abs(want) <= 1e-3
    return got


def spectrum_matrix(values, vectors):
    return vectors @ np.diag(values) @ vectors.T


@pytest.mark.parametrize("kind", ["plain", "equal", "zero", "sparse", "scaled"])
def test_rank_one_updates(kind):
    draw = np.random.default_rng(7)
    values, vectors, want = np.zeros(12), np.eye(12), np.zeros((12, 12))
    for step in range(60):
        u = draw.normal(size=12)
        if kind == "equal":
            u = np.eye(12)[step % 12] * 3
        elif kind == "zero" and step % 3:
            u = np.zeros(12)
        elif kind == "sparse":
            u[draw.integers(0, 12, 9)] = 0
        elif kind == "scaled":
            u *= 10.0 ** draw.integers(-6, 6)
        values, vectors = whitening.rank_one(values, vectors, 1.5, u)
        want += 1.5 * np.outer(u, u)
        scale = max(1e-300, np.abs(want).max())
        assert np.abs(spectrum_matrix(values, vectors) - want).max() <= 1e-11 * scale
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() <= 1e-11
        assert (np.diff(values) >= 0).all()


def test_merged_spectra_equal_one_of_all():
    x = np.random.default_rng(3).integers(-300, 300, (500, 9)) * np.arange(1, 10) + 1000
    whole, parts = whitening.Spectrum.of(x), [whitening.Spectrum.of(p) for p in np.array_split(x, [3, 4, 100, 450])]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.joined(part)
    centred = x - x.mean(axis=0)
    want = centred.T @ centred
    for found in (whole, merged):
        assert found.n == 500 and found.sums == x.sum(axis=0).tolist()
        assert np.abs(spectrum_matrix(found.values, found.vectors) - want).max() <= 1e-10 * np.abs(want).max()


def test_driver_embeddings(spark):
    check(spark.read.parquet(f"{SF}/embeddings.parquet"))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=3).tolist(), 1, "k", 2.0) for i in range(60)]
    rows += rows[:20] + [(100, None, 1, "k", 2.0), (101, [], 1, "k", 2.0), (102, [1.0, None, 2.0], 1, "k", 2.0), (103, [float("nan"), 1.0, 1.0], 1, "k", 2.0),
                         (104, [1.0, float("inf"), 1.0], 1, "k", 2.0), (None, [0.5, 0.25, -0.0], 1, "k", 2.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string, whitened double").repartition(40)
    got = check(df)
    assert {r[1] for r in got} == {1, 2, 3} and any(r[0] is None for r in got)
    assert not {r[0] for r in got} & {100, 101, 102, 103, 104}
    assert whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(df.where("vec_id >= 100")).collect() == []
    other = df.union(spark.createDataFrame([(200, [1.0, 2.0], 1, "k", 2.0)], df.schema))
    assert len(whitening.whitened(other).collect()) == len(got)


def test_without_variance(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], "vec_id long, embedding array<float>")
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whitening.whitened(same).collect()} == {(1, 0, None, 0.0, 0.0)}
    flat = spark.createDataFrame([(i, [i / 4, i / 2, 1.0]) for i in range(40)], "vec_id long, embedding array<float>")
    assert {(r.component, r.whitened is None) for r in whitening.whitened(flat).collect()} == {(1, False), (2, True), (3, True)}


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 0], [3, 4]])
    assert whitening.deviations(x, 1000, [5, 6]) == [None, (3000 - 5) ** 2 + (4000 - 6) ** 2]
    assert whitening.deviations(x[1:], 1000, [5, 6]) == [(3000 - 5) ** 2 + (4000 - 6) ** 2]
