"""Near duplicates by circulant MinHash, banding and exact Jaccard on full shingle sets.

A text's set holds its distinct shingles of ``shingle`` words (the whole sequence where there are fewer words), as 64-bit hashes.

1. *Classes.* Texts with equal sets are one class, with a 64-bit hash of the set as its node; from here on only classes are compared.
2. *Signature.* One permutation of ``PLACES`` places scatters the shingles; coordinate k is the smallest value that a second permutation,
   shifted circularly by k, gives to the places. So two permutations make all ``COORDINATES``; a row of the shifted table
   is a run of memory. Each band of ``ROWS`` coordinates gives a bucket; at a similarity of 0.8 a pair shares none of the buckets with a chance of 3e-6.
3. *Links.* Every candidate is confirmed on the full sets. Buckets are not turned into all their pairs: what is wanted is which classes hang
   together. First every member is compared with the smallest of its bucket. In buckets that still hold several components, signatures are
   compared in blocks of bounded size; members of different components that agree on at least ``AGREE`` below the threshold put
   their components into one cluster, of which each task reports a spanning forest only. Blocks of a cluster's members are then compared on
   full sets inside the tasks, which report the links that join components. No bucket is cut or sampled, and what is sent grows with the members, not with their pairs.
4. *Components* by alternating stars over the links of nodes; at the end each gets its smallest doc_id.

Nulls and edges: null, empty and blank texts have no set: they are linked with nothing and are their own component. Rows that repeat a doc_id are
judged by their own texts. Rows without doc_id follow the documents they equal; where all copies lack one, component_id is null and they are kept.
Ties go to the smaller doc_id. Empty tables give empty results; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import WordHashes, blank_words, gram_hashes, kept, mixed, utf8
from carelake.llm.components import components
from carelake.plans.session import small_batches, written

PLACES = 1 << 20
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
AGREE = 0.15
BLOCK = 256
SEED = 3


class TextWords(WordHashes):
    """Few words are remembered: the workers of an executor share its memory with the joins that run beside them."""

    LIMIT = 1 << 16


def shingles(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = hashes.of(blank_words(text))
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else words


@lru_cache(maxsize=2)
def permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the second one as a table of its circular shifts (a view, not copies)."""
    random = np.random.default_rng(seed)
    first, second = (random.permutation(PLACES).astype(np.int32) for _ in range(2))
    shifts = np.lib.stride_tricks.sliding_window_view(np.append(second, second[: COORDINATES - 1]), COORDINATES)
    return first, shifts


def signature(values: np.ndarray, seed: int = SEED) -> np.ndarray:
    first, shifts = permutations(seed)
    spots = first[(values % np.uint64(PLACES)).astype(np.int64)]
    least = np.full(COORDINATES, PLACES, np.int32)
    for at in range(0, len(spots), 2048):
        np.minimum(least, shifts[spots[at : at + 2048]].min(axis=0), out=least)
    return least


def bands(sign: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band; a band's coordinates lie far apart."""
    rows = sign.astype(np.uint64).reshape(ROWS, BANDS)
    total = np.arange(BANDS, dtype=np.uint64)
    for row in rows:
        total = mixed(total + row)
    return total.view(np.int64)


SCAN = "doc_id long, text_key long, n_shingles long, set_key binary, buckets array<bigint>, sign binary"


def scanned(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    kept("near_duplicates")
    hashes = TextWords()
    for batch in batches:
        counts, keys, found, signs = [], [], [], []
        for text in batch.column(2).to_pylist():
            values = shingles(text, size, hashes)
            counts.append(len(values))
            sign = signature(values) if len(values) else None
            keys.append(None if sign is None else xxhash.xxh3_128_digest(values))
            found.append(None if sign is None else bands(sign))
            signs.append(None if sign is None else sign.astype(np.uint8).tobytes())
            hashes.trim()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(found, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "set_key", "buckets", "sign"],
        )


def confirmed(batches: Iterator[pa.RecordBatch], size: int, part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the threshold. Rows come sorted by u, whose set is made once."""
    hashes, last, mine = TextWords(), None, np.empty(0, np.uint64)
    for batch in batches:
        us, vs, texts, others = (batch.column(i) for i in range(4))
        keep = []
        for i, u in enumerate(us.to_pylist()):
            if u != last:
                last, mine = u, shingles(texts[i].as_py(), size, hashes)
            theirs = shingles(others[i].as_py(), size, hashes)
            common = len(np.intersect1d(mine, theirs, assume_unique=True))
            if whole * common >= part * (len(mine) + len(theirs) - common):
                keep.append(i)
            hashes.trim()
        spots = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([us.take(spots), vs.take(spots)], names=["u", "v"])


@dataclass
class Side:
    """Members of one block."""

    ids: np.ndarray
    comps: np.ndarray
    sizes: np.ndarray
    signs: np.ndarray
    texts: list[bytes]

    @staticmethod
    def of(members: list[dict]) -> Side:
        return Side(
            np.array([m["node"] for m in members], np.int64), np.array([m["comp"] for m in members], np.int64),
            np.array([m["n"] for m in members], np.int64),
            np.frombuffer(b"".join(m["sign"] for m in members), np.uint8).reshape(len(members), COORDINATES),
            [m.get("text") for m in members],
        )


def joined(left: Side, right: Side, least: float, sizes: float, test: Callable[[int, int], bool] | None) -> Iterator[tuple[int, int]]:
    """Pairs of two blocks that join components, by signatures and, where given, by ``test``; each pair joins what was apart."""
    names = np.unique(np.concatenate([left.comps, right.comps]))
    now = names.copy()  # the joined component of each component
    mine, theirs = np.searchsorted(names, left.comps), np.searchsorted(names, right.comps)
    for i in range(len(left.ids)):
        agree = (right.signs == left.signs[i]).mean(axis=1)
        fits = (agree >= least) & (now[theirs] != now[mine[i]])
        fits &= np.minimum(right.sizes, left.sizes[i]) >= sizes * np.maximum(right.sizes, left.sizes[i])
        places = np.flatnonzero(fits)
        for j in places[np.argsort(-agree[places], kind="stable")].tolist():
            if now[theirs[j]] != now[mine[i]] and (test is None or test(i, j)):
                now[now == now[theirs[j]]] = now[mine[i]]
                yield i, j


def pair_batch(left: np.ndarray, right: np.ndarray, pairs: Iterator[tuple[int, int]]) -> pa.RecordBatch:
    found = list(pairs)
    us, vs = [left[i] for i, _ in found], [right[j] for _, j in found]
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def close_pairs(batches: Iterator[pa.RecordBatch], part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Per pair of blocks a spanning forest of the components that lie close by signature."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            left, right = Side.of(row["left"]), Side.of(row["right"])
            found = joined(left, right, part / whole - AGREE, (part - 0.001) / whole, None)
            yield pair_batch(left.comps, right.comps, found)


def linked_pairs(batches: Iterator[pa.RecordBatch], size: int, part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Per pair of blocks the confirmed links that join components."""
    hashes = TextWords()
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            left, right = Side.of(row["left"]), Side.of(row["right"])
            sets = [[shingles(text, size, hashes) for text in side.texts] for side in (left, right)]
            hashes.trim()

            def test(i: int, j: int, sets: list = sets) -> bool:
                a, b = sets[0][i], sets[1][j]
                common = len(np.intersect1d(a, b, assume_unique=True))
                return whole * common >= part * (len(a) + len(b) - common)

            found = joined(left, right, part / whole - AGREE, (part - 0.001) / whole, test)
            yield pair_batch(left.ids, right.ids, found)


def block_pairs(rows: DataFrame, group: str, *more: str) -> DataFrame:
    """Blocks of each group against each other: one row per pair of blocks, with the members of both."""
    counts = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(counts, group).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = F.struct("node", "comp", "n", "sign", *more)
    dealt = dealt.select(
        group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), member).alias("l"), F.when(F.col("own") >= F.col("other"), member).alias("r"),
    )
    paired = dealt.groupBy(group, "i", "j").agg(F.collect_list("l").alias("left"), F.collect_list("r").alias("right"))
    return paired.select("left", "right")


class Linker:
    """Suspects, their texts and the components so far."""

    def __init__(self, docs: DataFrame, reps: DataFrame, size: int, part: int, whole: int):
        self.size, self.part, self.whole = size, part, whole
        self.reps = reps
        rows = reps.select("rep", "node", "n", F.explode("buckets").alias("bucket"))
        shared = rows.groupBy("bucket").agg(F.min(F.struct("rep", "node", "n")).alias("first"), F.count(F.lit(1)).alias("members"))
        shared = shared.where("members > 1")
        self.members = written(rows.join(shared, "bucket"), "buckets")  # only buckets of two classes or more
        suspects = self.members.select("node").distinct().join(reps, "node").select(
            "node", F.col("rep").alias("doc_id"), "text_key"
        )
        self.texts = written(
            docs.join(suspects, ["doc_id", "text_key"]).dropDuplicates(["node"]).select("node", "text"), "suspects",
        )
        self.comps: DataFrame | None = None

    def by_smallest(self) -> None:
        """Each bucket's members against its smallest."""
        rows = self.members.where(F.col("node") != F.col("first.node"))
        a, b = F.col("n"), F.col("first.n")
        rows = rows.where(self.whole * F.least(a, b) >= self.part * F.greatest(a, b))
        pairs = written(rows.select(F.col("first.node").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
        rows = pairs.join(self.texts.select(F.col("node").alias("v"), F.col("text").alias("other")), "v")
        rows = rows.join(self.texts.select(F.col("node").alias("u"), "text"), "u").select("u", "v", "text", "other")
        size, part, whole = self.size, self.part, self.whole
        self.comps = components(rows.mapInArrow(lambda it: confirmed(it, size, part, whole), "u long, v long"))

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of each node so far."""
        labels = self.comps.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        return rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def by_blocks(self) -> None:
        """What is still open in buckets of several components."""
        size, part, whole = self.size, self.part, self.whole
        rows = self.labelled(self.members.select("bucket", "node", "n"))
        several = rows.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("bucket")
        still = written(rows.join(several, "bucket", "left_semi"), "open").join(self.reps.select("node", "sign"), "node")
        close = block_pairs(still, "bucket").mapInArrow(lambda it: close_pairs(it, part, whole), "u long, v long")
        clusters = components(close)
        named = clusters.select(F.col("u").alias("comp"), F.col("v").alias("cluster"))
        named = named.union(clusters.select(F.col("v").alias("comp"), F.col("v").alias("cluster"))).distinct()
        inside = still.dropDuplicates(["node"]).join(named, "comp").join(self.texts, "node")
        found = block_pairs(inside, "cluster", "text").mapInArrow(
            lambda it: linked_pairs(it, size, part, whole), "u long, v long"
        )
        self.comps = components(found.unionByName(self.comps))


def near_duplicates(
    docs: DataFrame, shingle: int = 5, part: int = 80, whole: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id and kept.

    Texts are linked if ``whole`` times their common shingles is at least ``part`` times all their shingles.
    ``text_key`` is xxhash64 of the text and finds the row again where a doc_id is repeated.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), utf8(text).alias("text")
    )
    with small_batches(docs.sparkSession):
        return judged(rows, shingle, part, whole)


def judged(rows: DataFrame, shingle: int, part: int, whole: int) -> DataFrame:
    """``near_duplicates`` of rows of doc_id, text_key and text; what is returned runs no Python any more."""
    scan = written(rows.mapInArrow(lambda it: scanned(it, shingle), SCAN), "signatures")
    classes = scan.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("least"),
        F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"), F.first("sign").alias("sign"),
    )
    classes = written(classes.select(
        "set_key", F.xxhash64("set_key").alias("node"), F.col("least.doc_id").alias("rep"),
        F.col("least.text_key").alias("text_key"), "n", "buckets", "sign",
    ), "classes")
    linker = Linker(rows, classes.where("rep IS NOT NULL").drop("set_key"), shingle, part, whole)
    linker.by_smallest()
    linker.by_blocks()
    labels = linker.comps.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    labels = labels.union(labels.select(F.col("comp").alias("node"), "comp").distinct())
    nodes = classes.where("rep IS NOT NULL").select("set_key", "node", "rep").join(labels, "node")
    smallest = written(nodes.groupBy("comp").agg(F.min("rep").alias("smallest")), "smallest")
    linked = nodes.join(smallest, "comp").select("set_key", "smallest")
    named = classes.select("set_key", "rep").join(linked, "set_key", "left").select(
        "set_key", F.coalesce("smallest", "rep").alias("component_id")
    )
    known = scan.where("n_shingles > 0").join(named, "set_key", "left")
    empty = scan.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "text_key", "n_shingles", "component_id"]
    found = known.select(*columns).unionByName(empty.select(*columns))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
