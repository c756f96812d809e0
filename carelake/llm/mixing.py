"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets. Sources in code point order, null last, take the weights in turn. They share all words by weight; a target stops at
``most`` times its source's words and the excess goes to the others by weight. Sorted by how soon they stop, the level at
which nothing is left over is the largest of the levels that each prefix of stopped sources would leave, so no loop is needed.

Blocks. A source's documents are dealt by hash into blocks of about ``block_words`` words (and documents). The source is taken
whole as often as its target allows, and in one more pass its permuted blocks up to the target. The block at the
target is cut: documents from large to small, as long as they fit. What is still missing goes on to the following blocks: those of their documents that
fit are summed up in the permuted order, up to the block that is cut next, until no later document fits. Every such round at least halves what is missing. These draws
are the exact block quotas.

Tree. Output shards hold equal numbers of draws. A node splits its quotas among the halves of its shards by a multivariate
hypergeometric draw seeded by the node, so each shard walks from the root to its own quotas alone, and along the way learns how many draws of each
source lie before it. It then takes the next draws of the source's permuted order: shards are disjoint and use up all
draws. Documents are shuffled inside their shard.

All random choices are hashes or seeded, so reruns agree. Only the table of sources (a row per source) is ever in one task or at the driver.

Nulls and edges: a null text has 0 words; a null source is a source; a null doc_id is an id like others. Documents of 0 words are drawn with their blocks. Rows
that repeat both doc_id and text are drawn together. An empty table gives an empty mix. Other columns pass through ``mixed`` unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import utf8
from carelake.plans.numbering import in_ranges, running_total
from carelake.plans.session import written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BLOCK_WORDS = 50_000
SHARD_BLOCKS = 64
SEED = 20


def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.array([len(t.split()) for t in batch.column(3).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), counts], names=["doc_id", "source", "key", "size"])


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text))


def sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        row_key(doc_id, text).alias("key"), utf8(text).alias("text"),
    )
    return written(rows.mapInArrow(sizes, "doc_id long, source string, key long, size long"), "sizes")


def targets(rows: DataFrame, weights: tuple[float, ...], most: int, block_words: int) -> DataFrame:
    """One row per source: s (its place), source, source_size, target, blocks."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    # From here on there is a row per source.
    places = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = totals.withColumn("s", F.row_number().over(places) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    weighed = numbered.select("*", weight.alias("weight"), limit.alias("stop"))
    soonest = Window.orderBy(F.col("stop") / F.col("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(soonest), F.lit(0.0))
    shared = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(soonest), F.lit(0.0))
    levels = weighed.withColumn("level", left / shared)
    level = F.max("level").over(everything)
    return levels.select(
        F.col("s").cast("int").alias("s"), "source", "source_size",
        F.least("stop", level * F.col("weight")).alias("target"),
        F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("rows")) / block_words)).cast("long").alias("blocks"),
    )


def block_of(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


CUT = "s int, block long, upto long, left double, chosen array<bigint>"


def cut(rows: pa.Table) -> pa.Table:
    """Documents of one block, from large to small, as long as they fit what is missing."""
    gap, chosen = rows.column("gap")[0].as_py(), []
    sizes = sorted(zip(rows.column("size").to_pylist(), rows.column("key").to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
    for size, key in sizes:
        if 0 < size <= gap:
            gap -= size
            chosen.append(key)
    one = [rows.column(name).slice(0, 1) for name in ("s", "block", "upto")]
    return pa.table([*one, pa.array([gap], pa.float64()), pa.array([chosen], pa.list_(pa.int64()))], names=["s", "block", "upto", "left", "chosen"])


def filled_up(placed: DataFrame, blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """s, block and chosen (null for a whole block) of what is drawn up to the targets; ``chosen`` comes from the first cut blocks."""
    columns = ["s", "block", "chosen"]
    found = chosen.where(F.size("chosen") > 0).select(*columns)
    edge = lambda cuts: cuts.where("left > 0").select("s", F.col("upto").alias("at"), F.col("left").alias("gap"))
    state = edge(chosen)  # a row per source
    rows = placed.select("s", "block", "key", "size").join(blocks.select("s", "block", "upto", "words"), ["s", "block"])
    fits = (F.col("upto") > F.col("at")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
    # A row that does not fit is part of no document that fits.
    rows = rows.join(state, "s").where(fits).groupBy("s", "block", "key", "upto", "words").agg(F.sum("size").alias("size"))
    while True:
        later = written(rows.join(state, "s").where(fits).drop("at", "gap"), "later")
        if later.isEmpty():
            return found
        sums = later.groupBy("s", "block", "upto", "words").agg(F.sum("size").alias("fit"))
        ordered = in_ranges(sums, "s", "upto", "block")
        summed = running_total(ordered, ["s"], "upto", F.col("fit"), "sum").join(state, "s")
        missing = F.col("gap") - (F.col("sum") - F.col("fit"))
        reached = written(summed.where(missing > 0).select(
            "s", "block", (F.col("sum") <= F.col("gap")).alias("all"), (F.col("fit") == F.col("words")).alias("full"), missing.alias("gap")
        ), "reached")
        inside = later.join(reached.where(~F.col("all")).select("s", "block", "gap"), ["s", "block"])
        chosen = written(inside.groupBy("s", "block").applyInArrow(cut, CUT), "cut")
        partly = later.join(reached.where(F.col("all") & ~F.col("full")).select("s", "block"), ["s", "block"])
        found = found.unionByName(reached.where(F.col("all") & F.col("full")).select(
            "s", "block", F.lit(None).cast("array<bigint>").alias("chosen")
        )).unionByName(partly.groupBy("s", "block").agg(F.collect_list("key").alias("chosen")))
        found = found.unionByName(chosen.where(F.size("chosen") > 0).select(*columns))
        rows, state = later, edge(chosen)


def split(totals: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws of each source in a shard, and before it: the walk from the root of the splitting tree."""
    whole = int(totals.sum())
    edge = lambda i: whole * i // shards
    own, before = totals.astype(np.int64).copy(), np.zeros(len(totals), np.int64)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        random = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = random.multivariate_hypergeometric(own, edge(middle) - edge(low), method="marginals")
        if shard < middle:
            own, high = left, middle
        else:
            own, before, low = own - left, before + left, middle
    return own, before


def shares(batches: Iterator[pa.RecordBatch], totals: list[int], shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple[int, int, int, int]] = []
        for shard in batch.column(0).to_pylist():
            own, before = split(np.array(totals, np.int64), shards, shard, seed)
            rows += [(shard, s, int(before[s]), int(own[s])) for s in np.flatnonzero(own).tolist()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "s", "first", "n"])


@dataclass(frozen=True)
class Mix:
    """``rows``: doc_id, source, key, size; ``sources``: targets per source; ``draws``: s, block, pass, chosen, shard.

    ``chosen`` is null for a whole block and else the keys of the documents taken from it.
    """

    rows: DataFrame
    sources: DataFrame
    draws: DataFrame
    shards: int


def planned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
) -> Mix:
    spark = docs.sparkSession
    rows = sized(docs, doc_id, text, source)
    sources = written(targets(rows, weights, most, block_words), "sources")
    placed = rows.join(
        sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).withColumn("block", block_of(F.col("key"), F.col("blocks")))
    filled = placed.groupBy("s", "block").agg(F.sum("size").alias("words"))
    ordered = in_ranges(filled.withColumn("place", F.xxhash64(F.lit(seed), "s", "block")), "s", "place", "block")
    summed = running_total(ordered, ["s"], "place", F.col("words"), "upto").join(
        sources.select("s", "source_size", "target"), "s"
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - passes * F.col("source_size")
    blocks = written(summed.select(
        "s", "block", "upto", "words", passes.alias("passes"),
        ((F.col("upto") <= rest) & (rest > 0)).alias("whole"), (rest - (F.col("upto") - F.col("words"))).alias("gap"),
    ), "blocks")
    # At most one block of each source stands at the target.
    edges = blocks.where(~F.col("whole") & (F.col("gap") > 0)).select("s", "block", "upto", "gap")
    inside = placed.groupBy("s", "block", "key").agg(F.sum("size").alias("size")).join(edges, ["s", "block"])
    chosen = written(inside.groupBy("s", "block").applyInArrow(cut, CUT), "cut")
    again = F.explode(F.sequence(F.lit(1), F.col("passes") + F.col("whole").cast("int"))).alias("pass")
    several = blocks.where((F.col("passes") + F.col("whole").cast("int")) > 0).select(
        "s", "block", again, F.lit(None).cast("array<bigint>").alias("chosen")
    )
    partly = filled_up(placed, blocks, chosen).withColumn("pass", F.lit(0))
    drawn = several.unionByName(partly).withColumn("place", F.xxhash64(F.lit(seed + 1), "s", "block", "pass"))
    drawn = in_ranges(drawn, "s", "place", "block", "pass")
    drawn = running_total(drawn, ["s"], "range_row", F.lit(1), "position")
    counted = {r["s"]: r["n"] for r in drawn.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}  # per source
    totals = [counted.get(s, 0) for s in range(max(counted, default=-1) + 1)]
    shards = max(1, -(-sum(totals) // shard_blocks))
    quotas = spark.range(shards).mapInArrow(
        lambda it: shares(it, totals, shards, seed), "shard long, s long, first long, n long"
    )
    numbers = F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("n"))).alias("position")
    dealt = quotas.select("shard", F.col("s").cast("int").alias("s"), numbers)
    draws = drawn.select("s", "block", "pass", "chosen", "position").join(dealt, ["s", "position"]).drop("position")
    return Mix(rows, sources, written(draws, "draws"), shards)


def taken(mix: Mix) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target and taken (words drawn, repeats counted)."""
    per_block = mix.draws.groupBy("s", "block").agg(
        F.count_if(F.col("chosen").isNull()).alias("times"), F.first("chosen", ignorenulls=True).alias("chosen")
    )
    rows = mix.rows.join(
        mix.sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).withColumn("block", block_of(F.col("key"), F.col("blocks")))
    times = F.coalesce("times", F.lit(0)) + F.coalesce(F.array_contains("chosen", F.col("key")), F.lit(False)).cast("int")
    return rows.join(per_block, ["s", "block"], "left").select(
        "doc_id", "size", "source", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as drawn, shard by shard and shuffled inside each shard."""
    kept = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(kept, row_key(doc_id, text).alias("key"), F.col(source).cast("string").alias("own_source"))
    placed = rows.join(mix.sources, F.col("own_source").eqNullSafe(F.col("source")))
    placed = placed.select("row", "key", "s", block_of(F.col("key"), F.col("blocks")).alias("block"))
    drawn = placed.join(mix.draws, ["s", "block"]).where(
        F.col("chosen").isNull() | F.array_contains("chosen", F.col("key"))
    )
    local = F.xxhash64(F.lit(SEED), "key", "pass")
    return (
        drawn.select("row", "shard", local.alias("place"))
        .repartition("shard").sortWithinPartitions("shard", "place").select("row.*")
    )
