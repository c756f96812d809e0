from __future__ import annotations

import hashlib
import random
from collections import Counter

from carelake.llm import exact_copies
from llm_support import ordered, table_rows

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    """One row per document; of rows that repeat id and text one stays."""
    groups: dict = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    found = []
    for text, ids in groups.items():
        ids.sort(key=lambda x: (x is not None, x or 0), reverse=True)
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(doc, ids[0], len(ids), i == 0, sha) for i, doc in enumerate(ids)]
    return found


def check(df, **options):
    got = table_rows(exact_copies.exact_copies(df, digest=True, **options), *COLUMNS)
    assert ordered(got) == ordered(brute(table_rows(df, "doc_id", "text")))


def test_driver_documents(documents):
    check(documents)


def test_odd_rows(odd, nothing):
    check(odd)
    check(nothing)


def test_texts_that_agree_in_length_and_prefix(spark):
    draw = random.Random(3)
    start = "p" * 200
    rows = [(i, start + "".join(draw.choice("ab") for _ in range(4))) for i in range(200)]
    rows += [(200 + i, "one text of many copies ß") for i in range(300)] + [(600 + i, "x" * i) for i in range(60)] + [(700, None), (701, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(df)
    check(df, bits=16)  # a crowded bitmap only costs hashes


def test_only_shared_groups_are_hashed(spark):
    rows = [(1, "a" * 100 + "x"), (2, "a" * 100 + "y"), (3, "b" * 101), (4, "c"), (5, "dd"), (6, "dd")]
    shapes = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("octet_length(text) length", "xxhash64(substring(text, 1, 64)) prefix")
    bits = 0
    for row in exact_copies.shared_prefixes(shapes, 20).collect():
        bits += sum(bin(b).count("1") for b in row.bitmap)
    assert bits == 2  # the texts of 101 bytes that start alike, and the two copies


def test_without_digest_and_other_names(odd):
    df = odd.withColumnsRenamed({"doc_id": "row_no", "text": "full_hash"})
    got = exact_copies.exact_copies(df, "row_no", "full_hash")
    assert got.columns == ["row_no", "keep_id", "group_size", "kept"]
    assert Counter(got.select("group_size").toPandas().group_size) == Counter(x[2] for x in brute(table_rows(odd, "doc_id", "text")))


def test_no_python_and_no_texts_in_a_shuffle(documents):
    plan = exact_copies.exact_copies(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
