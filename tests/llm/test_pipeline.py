"""The pipeline against a plain version of each stage's decision, and the registered SQL against Spark."""

from __future__ import annotations

import re
import weakref
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from carelake.llm import language, mixing, near_duplicates, registered, token_files
from llm_support import SF, table_rows
from test_near_duplicates import brute as duplicates
from test_winnowing import brute as contaminated
from tools.check import rows_of


def test_stages_on_the_driver_documents(spark, documents, tmp_path):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_files":
            assert result.columns == documents.columns
            kept[name], docs = table_rows(result, "doc_id", "text"), result
    rejected = language.predicted(documents, language.fit(documents)).where("language.rejected").count()
    assert len(kept["language"]) == documents.count() - rejected
    found = duplicates(kept["language"], 5, 80, 100)
    assert sorted(i for i, _ in kept["near_duplicates"]) == sorted(r[0] for r in found if r[3])
    items = table_rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    clean = [r[0] for r in contaminated(kept["near_duplicates"], items) if not r[5]]
    assert sorted(i for i, _ in kept["decontamination"]) == sorted(clean)
    times = Counter(i for i, _ in kept["mixing"])
    before = spark.read.parquet(f"{tmp_path}/decontamination")
    for r in mixing.taken(mixing.planned(before)).collect():
        assert times[r.doc_id] <= 3 and (r.size == 0 or times[r.doc_id] == r.taken // r.size)
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    encoded = sorted(table_rows(spark.read.parquet(f"{tmp_path}/token_files"), "start", "doc_id", "n_tokens", "ids_crc32"))
    for row, (i, text) in zip(encoded, sorted(kept["mixing"]), strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert row == (start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows(spark, odd, nothing):
    for docs, least in ((odd, 1), (nothing, 0)):
        docs = docs.select("doc_id", "text", "lang", "source", "n_words")
        for name, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            docs = spark.createDataFrame(after.collect(), docs.schema)
            assert docs.count() >= least * (name != "mixing")
            if name == "near_duplicates" and least:
                ids = [r.doc_id for r in docs.collect()]
                assert ids.count(5) == 1 and 6 not in ids
    assert corpus_pipeline.token_files_stage(spark, nothing, SF).count() == 0


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(registered.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    df = registered.queries()[name](spark, SF)
    assert rows_of(df.columns, df.collect()) == want


def test_columns_of_any_name_pass_unchanged(spark):
    names = ["language_", "language", "gone_id", "gone_key", "again_id", "row", "a.b", "text_key", "kept", "key"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").limit(40)
    docs = docs.select("*", *(F.concat(F.lit(f"{n} of "), F.col("doc_id")).alias(n) for n in names))
    docs = docs.union(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert rows and all(row[n] == f"{n} of {row.doc_id}" for row in rows for n in names), name


def test_every_query_is_registered():
    names = set(registered.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline"} == set(range(1, 14)) and "pipeline" in names


def test_workers_drop_what_another_operator_kept(documents):
    """The token files' pieces stayed in each worker, 250 MB of them, beside the memory of all stages that came later."""
    words = weakref.ref(token_files.encoder(public_tokenizers.path(corpus_pipeline.VOCABULARY)))
    assert token_files.encoder(public_tokenizers.path(corpus_pipeline.VOCABULARY)) is words()
    rows = documents.selectExpr("doc_id", "1L AS text_key", "CAST(text AS BINARY) AS text").limit(3).toArrow().to_batches()
    assert sum(b.num_rows for b in near_duplicates.scanned(iter(rows), 5)) == 3
    assert words() is None
