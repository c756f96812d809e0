from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import hidden_markov
from carelake.llm.queries import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hidden_markov, "STATES", 3)
    monkeypatch.setattr(hidden_markov, "CLASSES", 4)
    draw = np.random.default_rng(0)
    start, move, emit = draw.random(3), draw.random((3, 3)), draw.random((5, 3))
    chain = hidden_markov.Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return chain, [np.array(s) for s in ([1, 2, 0], [0], [4, 3, 2, 1, 0], [1, 1, 1, 0])]


def paths(chain, tokens):
    for path in itertools.product(range(3), repeat=len(tokens)):
        p = chain.start[path[0]] * chain.emit[tokens[0], path[0]]
        for i in range(1, len(tokens)):
            p *= chain.move[path[i - 1], path[i]] * chain.emit[tokens[i], path[i]]
        yield path, p


def test_forward_is_the_sum_over_all_paths(small):
    chain, sequences = small
    for tokens, log in zip(sequences, hidden_markov.likelihoods(chain, sequences), strict=True):
        assert log == pytest.approx(math.log10(sum(p for _, p in paths(chain, tokens))))


def test_expected_counts_are_those_of_all_paths(small):
    chain, sequences = small
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for tokens in sequences:
        total = sum(p for _, p in paths(chain, tokens))
        for path, p in paths(chain, tokens):
            start[path[0]] += p / total
            for i, s in enumerate(path):
                emit[tokens[i], s] += p / total
                if i:
                    move[path[i - 1], s] += p / total
    found = hidden_markov.Expected.none()
    hidden_markov.expectation(chain, sequences, found)
    assert np.allclose(found.start, start) and np.allclose(found.move, move) and np.allclose(found.emit, emit)


def test_driver_documents(spark):
    rows = queries()["op7_hidden_markov"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), b" "] for r in docs}
    learned = Counter()
    for i, own in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            learned.update(own)
    n, v = sum(learned.values()), len(learned)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(learned[t] > 0 for t in own), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(sum(math.log10((learned[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_do_not_depend_on_blocks(spark, documents):
    held = F.lit(False)
    few = {r.doc_id: r.score for r in hidden_markov.scored(documents, held).collect()}
    many = {r.doc_id: r.score for r in hidden_markov.scored(documents, held, block_bytes=20_000).collect()}
    assert few == pytest.approx(many)


def test_odd_rows(odd, nothing):
    rows = hidden_markov.scored(odd, F.lit(False)).collect()
    assert len(rows) == 12 and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    unknown = hidden_markov.scored(odd, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in unknown} == {(0, 0, 0.0)}
    assert hidden_markov.scored(nothing, F.lit(False)).count() == 0


def test_texts_longer_than_any_sample_would_hold_are_learned(spark):
    """Two kinds of long texts: the states tell them apart, which a start from short texts alone could not show them."""
    draw = np.random.default_rng(1)
    kinds = [[f"{kind}{i}" for i in range(40)] for kind in ("left", "right")]
    texts = [" ".join(draw.choice(kinds[i % 2], 4000)) for i in range(24)]
    classes = hidden_markov.WordClasses()
    sequences = hidden_markov.sequences_of([t.encode() for t in texts], classes)
    counts = np.bincount(np.concatenate(sequences), minlength=hidden_markov.CLASSES + 1).astype(float)
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    chain = hidden_markov.trained(train, "text", hidden_markov.PASSES, counts)
    usual = np.log10((counts + 1e-9) / counts.sum())
    found = hidden_markov.likelihoods(chain, sequences)
    assert found.sum() > sum(usual[s].sum() for s in sequences) * 0.9
