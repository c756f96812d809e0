"""Benchmark decontamination by winnowing.

A window is ``width`` consecutive words of a benchmark item (the whole item where it has fewer). Both sides are hashed into
k-grams and, of every ``width - k + 1`` consecutive k-grams, keep the one of smallest hash (the last one on ties). The choice
depends on the window's words alone, so any shared window leaves a common fingerprint: nothing of that length is missed. Documents
and items are joined on fingerprints; each match is then extended word by word in both directions. Matches carry the words
around them, as far as a window can reach, so no whole text is joined.

* Before the join, document fingerprints pass a bitmap of the benchmark's fingerprints (``FILTER_BITS`` bits, a fixed size). It only
  saves traffic: where a large benchmark fills it, more rows reach the join and the result is the same.
* Copies: results depend on words alone, so rows with the same text share one key and are joined once per task; items
  with the same words are one class.

Nulls and edges: a null or empty text has no words, is never hit and never an item; a null item_id counts for hits and is not listed; rows that repeat a
doc_id are judged one by one; an empty benchmark hits nothing. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import WordHashes, alnum_words, gram_hashes, mixed, utf8
from carelake.plans.session import written

WIDTH = 13
GRAM = 5
FILTER_BITS = 1 << 20


def selected(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every ``window`` consecutive hashes, the last on ties."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(window - 1, len(hashes)) - views[:, ::-1].argmin(axis=1))


def fingerprints(hashes: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of a text for windows of one width; the width is part of the fingerprint."""
    k = min(gram, width)
    grams = gram_hashes(hashes, k)
    places = selected(grams, width - k + 1)
    return places, mixed(grams[places] + np.uint64(width))


def around(words: list[bytes], place: int, k: int, reach: int) -> tuple[int, bytes]:
    """The k-gram with ``reach`` words on either side, and how many of them stand before it."""
    start = max(0, place - reach)
    return place - start, b" ".join(words[start : place + k + reach])


ITEM_SCHEMA = "class binary, item_id string, width int, fp long, at int, context binary"


def item_rows(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        out = {name: [] for name in ("class", "item_id", "width", "fp", "at", "context")}
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = alnum_words(text)
            if not words:
                continue
            own, key = min(width, len(words)), xxhash.xxh3_128_digest(b" ".join(words))
            k = min(gram, own)
            places, fps = fingerprints(hashes.of(words), own, gram)
            for place, fp in zip(places.tolist(), fps.view(np.int64).tolist(), strict=True):
                at, context = around(words, place, k, own - k)
                for name, value in zip(out, (key, item, own, fp, at, context), strict=True):
                    out[name].append(value)
        hashes.trim()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["class"], pa.binary()), pa.array(out["item_id"], pa.string()), pa.array(out["width"], pa.int32()),
             pa.array(out["fp"], pa.int64()), pa.array(out["at"], pa.int32()), pa.array(out["context"], pa.binary())],
            names=list(out),
        )


CANDIDATE = pa.struct([
    ("width", pa.int32()), ("fp", pa.int64()), ("place", pa.int32()), ("at", pa.int32()), ("context", pa.binary()),
])
DOCUMENT_SCHEMA = (
    "doc_id long, text_key long, n_words long, key binary, "
    "candidates array<struct<width:int,fp:bigint,place:int,at:int,context:binary>>"
)


def buckets(fps: np.ndarray, bits: int) -> np.ndarray:
    return fps % np.uint64(bits)


def document_rows(
    batches: Iterator[pa.RecordBatch], widths: list[int], gram: int, bitmap: bytes, bits: int
) -> Iterator[pa.RecordBatch]:
    present = np.unpackbits(np.frombuffer(bitmap, np.uint8)).astype(bool)
    hashes, done = WordHashes(), set()
    for batch in batches:
        counts, keys, found = [], [], []
        for text in batch.column(1).to_pylist():
            words = alnum_words(text)
            key = xxhash.xxh3_128_digest(text)
            candidates = []
            if key not in done:
                values = hashes.of(words)
                for width in widths:
                    if len(words) < width:
                        continue
                    k = min(gram, width)
                    places, fps = fingerprints(values, width, gram)
                    kept = present[buckets(fps, bits)]
                    for place, fp in zip(places[kept].tolist(), fps[kept].view(np.int64).tolist(), strict=True):
                        at, context = around(words, place, k, width - k)
                        candidates.append({"width": width, "fp": fp, "place": place, "at": at, "context": context})
                if candidates:
                    done.add(key)
            counts.append(len(words))
            keys.append(key)
            found.append(candidates)
        hashes.trim()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(found, pa.list_(CANDIDATE))],
            names=["doc_id", "text_key", "n_words", "key", "candidates"],
        )


def extended(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Spans of document words that agree with an item on a window's width or more."""
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in range(7)), strict=True)
        out: set[tuple] = set()
        for key, place, at, context, name, item_at, item_context in rows:
            mine, theirs = context.split(b" "), item_context[1:].split(b" ")
            width = item_context[0]
            k = min(gram, width)
            if mine[at : at + k] != theirs[item_at : item_at + k]:
                continue
            left = 0
            while left < min(at, item_at) and mine[at - left - 1] == theirs[item_at - left - 1]:
                left += 1
            right = k
            while at + right < len(mine) and item_at + right < len(theirs) and mine[at + right] == theirs[item_at + right]:
                right += 1
            if left + right >= width:
                out.add((key, name, place - left, place + right))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()),
             pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
            names=["key", "class", "lo", "hi"],
        )


def benchmark_hits(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, gram: int = GRAM, bits: int = FILTER_BITS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, text_key, n_words, key), spans (key, class, lo, hi) and items (class, item_id).

    A span is a run of document words, from ``lo`` and before ``hi``, that stands in an item of the class.
    """
    listed = items.select(F.col(item_id).cast("string").alias("item_id"), utf8(item_text).alias("text"))
    prints = written(listed.mapInArrow(lambda it: item_rows(it, width, gram), ITEM_SCHEMA), "item-fingerprints")
    widths = sorted(r["width"] for r in prints.select("width").distinct().collect())
    # At most FILTER_BITS numbers, whatever the size of the benchmark.
    size = F.lit(bits)
    set_bits = prints.select(F.pmod(F.col("fp"), size).alias("bit"), (F.col("fp") < 0).alias("neg")).distinct().collect()
    wrap = (1 << 64) % bits
    bitmap = np.zeros(bits, bool)
    for row in set_bits:  # fp is unsigned in Python and signed in Spark
        bitmap[(row["bit"] + wrap * row["neg"]) % bits] = True
    packed = np.packbits(bitmap).tobytes()
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"), F.xxhash64(F.col(text)).alias("text_key")
    )
    scanned = written(
        rows.mapInArrow(lambda it: document_rows(it, widths, gram, packed, bits), DOCUMENT_SCHEMA), "fingerprints"
    )
    candidates = scanned.where(F.size("candidates") > 0).select("key", F.explode("candidates").alias("c"))
    candidates = candidates.select("key", "c.width", "c.fp", "c.place", "c.at", "c.context")
    contexts = prints.select(
        "class", "width", "fp", F.col("at").alias("item_at"),
        F.concat(F.unhex(F.lpad(F.hex("width"), 2, "0")), F.col("context")).alias("item_context"),
    ).distinct()
    matched = candidates.join(contexts, ["width", "fp"]).select(
        "key", "place", "at", "context", "class", "item_at", "item_context"
    )
    spans = matched.mapInArrow(lambda it: extended(it, gram), "key binary, class binary, lo long, hi long").distinct()
    return (
        scanned.select("doc_id", "text_key", "n_words", "key"),
        written(spans, "hit-spans"),
        prints.select("class", "item_id").where(F.col("item_id").isNotNull()).distinct(),
    )


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **options) -> DataFrame:
    """Per document: doc_id, text_key (xxhash64 of the text), n_words, n_hit, n_items, item_ids (sorted text) and contaminated.

    A document is contaminated if it has a hit word and ``share`` times its hit words are at least its words.
    """
    found, spans, members = benchmark_hits(docs, items, **options)
    before = Window.partitionBy("key").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.select("key", "lo", "hi").distinct().withColumn("seen", F.max("hi").over(before))
    fresh = F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce("seen", "lo")))
    hits = covered.groupBy("key").agg(F.sum(fresh).alias("n_hit"))
    listed = spans.select("key", "class").distinct().join(members, "class")
    listed = listed.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    # Written, so that the join below stands alone: it is broadcast if small, and else a much copied text is split.
    judged = written(hits.join(listed, "key", "left"), "hits")
    none = F.array().cast("array<string>")
    rows = found.join(judged, "key", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids")
    )
    return rows.select(
        "doc_id", "text_key", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
