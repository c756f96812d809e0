"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import collocations, exact_copies, hidden_markov, language, licenses, line_matches, mixing, near_duplicates, neighbours, secret_scan, token_files, whitening, winnowing
from carelake.llm.common import id_crc
from carelake.llm.shipping import ship
from carelake.plans.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch space."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc("doc_id"), F.lit(4)) == 2
    model = language.fit(docs.where(~held_out))
    found = language.predicted(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "language.*")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, part=85, whole=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_line_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_matches.without_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_removed", kept)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.planned(table(spark, sf_dir, "documents"))
    return mixing.taken(mix).select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "novel")

    def joined(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(id_crc("doc_id"), F.lit(5)) == 1
    return hidden_markov.scored(table(spark, sf_dir, "documents"), held_out)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_file(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return token_files.read_token_file(spark, path, digest=True)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.col("licenses.base.place")
    return found.select(
        "doc_id", F.col("licenses.n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join("licenses.base_labels", ",").alias("base_labels"), F.array_join("licenses.labels", ",").alias("labels"),
        F.col("licenses.score").alias("score"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked(collocations.collocations(table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.exact_copies(table(spark, sf_dir, "documents"), digest=True)


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_language": op2_language,
    "op9_winnowing": op9_winnowing,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_line_matches": op4_line_matches,
    "op5_mixing": op5_mixing,
    "op10_licenses": op10_licenses,
    "op6_secret_scan": op6_secret_scan,
    "op7_hidden_markov": op7_hidden_markov,
    "op8_token_files": op8_token_files,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_exact_copies": op13_exact_copies,
}


def queries() -> dict[str, Query]:
    """Every query, made to bring the package to the workers first."""

    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {name: shipped(query) for name, query in QUERIES.items()}
