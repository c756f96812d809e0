from __future__ import annotations

import random
import re

import numpy as np

from carelake.llm import winnowing
from llm_support import SF, ordered, table_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs, items):
    windows: dict = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault((n, tuple(words[i : i + n])), set()).add(item)
    widths, found = {n for n, _ in windows}, []
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, listed = set(), set()
        for n in widths:
            for i in range(len(words) - n + 1):
                if own := windows.get((n, tuple(words[i : i + n]))):
                    hit |= set(range(i, i + n))
                    listed |= own
        listed = sorted(str(x) for x in listed if x is not None)
        found.append((doc, len(words), len(hit), len(listed), listed, bool(hit) and 20 * len(hit) >= len(words)))
    return found


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated")


def check(docs, items):
    got = table_rows(winnowing.contamination(docs, items), *COLUMNS)
    assert ordered(got) == ordered(brute(table_rows(docs, "doc_id", "text"), table_rows(items, "item_id", "text")))


def test_driver_documents(spark, documents):
    check(documents, spark.read.parquet(f"{SF}/benchmark.parquet"))


def test_a_full_filter_loses_nothing(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = table_rows(winnowing.contamination(documents, items, bits=8), *COLUMNS)
    assert ordered(got) == ordered(table_rows(winnowing.contamination(documents, items), *COLUMNS))


def test_short_repeated_and_empty_items(spark, odd, nothing):
    long = "a b c d e f g h i j k l m n o p q r s t"
    docs = [
        (1, f"x {long} y"), (2, "the cat sat"), (2, "the cat sat"), (3, None), (None, ""), (4, "z " * 40 + "d e f g h i j k l m n o p"),
        (5, "a " * 17), (6, "THE CAT-sat, on"), (7, "b c d e f g h i j k l m"),
    ]
    items = [(1, long), (2, long), (3, "cat sat"), (4, None), (None, "sat on"), (5, "a " * 14), (5, "a " * 14), (6, "e F g h I"), (7, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    check(docs, items)
    check(docs, items.limit(0))
    check(odd, items)
    check(nothing, items)


def test_random_copies_of_windows(spark):
    draw = random.Random(5)
    items = [(i, " ".join(draw.choice("abcdefgh") for _ in range(draw.randrange(3, 60)))) for i in range(30)]
    docs = []
    for i in range(120):
        words = [draw.choice("abcdefghijkl") for _ in range(40)]
        own = draw.choice(items)[1].split()
        start = draw.randrange(len(own))
        words[10:10] = own[start : start + draw.randrange(5, 25)]
        docs.append((i, " ".join(words)))
    check(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def test_every_window_keeps_a_fingerprint():
    hashes = np.random.default_rng(6).integers(0, 50, 300).astype(np.uint64)
    places = set(winnowing.selected(hashes, 9).tolist())
    assert all(places & set(range(i, i + 9)) for i in range(292))
