"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; ``run`` writes each result as Parquet and reads it
again for the next. All but the last return the columns of ``docs``.

1. language: documents whose language is rejected go (no letter, or a prediction more likely wrong than right).
2. near_duplicates: one document of each group of near copies stays (five-word shingles, similarity 0.8), and one of repeated rows.
3. decontamination: documents with a twentieth or more of their words in benchmark passages go.
4. mixing: documents are repeated or left out so that the sources approach their target shares, and shuffled.
5. token_files: whole texts are encoded and written; the result describes each document's ids as read back.

Null, empty and repeated rows follow the rules stated by each operator; an empty table stays empty throughout.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import language, mixing, near_duplicates, token_files, winnowing
from carelake.llm.shipping import ship
from carelake.plans.session import scratch_folder

VOCABULARY, END_ID = "word_bpe_49k.json", 2


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as one struct ``row``, where no name can clash with a stage's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def named(rows: DataFrame, *columns: str) -> DataFrame:
    """Columns of packed documents under their names, for an operator that reads these."""
    return rows.select(*(F.col(f"row.{c}").alias(c) for c in columns))


def without(rows: DataFrame, gone: DataFrame, how: str = "left_anti") -> DataFrame:
    """The packed documents whose doc_id and text_key are not in ``gone`` (or, with ``left_semi``, are)."""
    keys = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("row.text") == F.col("gone_key"))
    return rows.join(keys, same, how)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = packed(docs)
    found = language.predicted(rows, language.fit(named(rows, "text", "lang")), text="row.text")
    return found.where(~F.col("language.rejected")).select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = packed(docs)
    found = near_duplicates.near_duplicates(named(rows, "doc_id", "text"))
    rest = without(rows, found.where(~F.col("kept")))
    repeated = found.where("kept").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if repeated.isEmpty():
        return rest.select("row.*")
    again = without(rest, repeated, "left_semi").select(F.col("row.doc_id").alias("same_id"), F.col("row.text").alias("same_text"), "row")
    again = again.dropDuplicates(["same_id", "same_text"]).select("row")
    return without(rest, repeated).unionByName(again).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows, items = packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = winnowing.contamination(named(rows, "doc_id", "text"), items)
    return without(rows, found.where("contaminated")).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed(docs, mixing.planned(docs))


def token_files_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    path = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_token_file(docs, path, public_tokenizers.path(VOCABULARY), END_ID)
    return token_files.read_token_file(spark, path, digest=True)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_files_stage),
]

# Models, hashing choices and the tokenizer cannot be said in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
