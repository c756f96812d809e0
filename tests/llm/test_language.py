from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import language
from carelake.llm.queries import queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op2_language"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    row = got.where("held_out").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.sum(F.col("rejected").cast("int")).alias("rejected"),
    ).first()
    assert row.right >= 0.97 * row.n and row.rejected <= 0.01 * row.n
    assert got.where("score < 0 OR score > 1").isEmpty()


def test_odd_rows(spark, odd, nothing):
    model = language.fit(odd)
    rows = language.predicted(odd, model).collect()
    assert len(rows) == 12
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.language.lang_pred == "und") == (not letters)
        assert letters or (r.language.score == 0 and r.language.rejected)
    untaught = language.fit(nothing)
    assert {r.language.lang_pred for r in language.predicted(odd, untaught).collect()} == {"und"}
    assert language.predicted(nothing, model).count() == 0


def test_long_texts_are_summed_over_blocks():
    random = np.random.default_rng(0)
    table = np.zeros((language.BUCKETS + 1, 2))
    table[1:] = random.normal(size=(language.BUCKETS, 2))
    text = b"".join(random.choice([b"ab ", b"cd", b"xyz ", b"\xc3\xa9"], 900_000).tolist())
    assert len(text) > language.BLOCK
    together = language.sums([b"one", text, b"two"], table)
    data, _ = language.buffered([text])
    ids = language.subwords(data, len(data))
    assert np.allclose(together[1], table[ids].sum(axis=(0, 1)))
    assert np.allclose(together[2], language.sums([b"two"], table)[0])


def test_pieces_are_the_whole_text():
    text = b"some words " * 500
    assert b"".join(language.pieces(text)) == text
