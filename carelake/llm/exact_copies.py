"""Exact dedup by progressive refinement: length, then a hash of a prefix, then a hash of the whole text.

1. *Length.* One scan keeps the byte length and the hash of the first ``PREFIX`` characters of each text, nothing else. Rows whose length
   is the only one of its kind are alone and leave.
2. *Prefix hash.* Among the rest, rows are counted by length and prefix hash. Pairs of length and prefix that occur once leave.
3. *Full hash.* A second scan hashes the whole text (SHA-256) of rows in surviving groups only. Rows of equal length and hash are equal texts.

Surviving lengths and groups reach the next step as a bitmap of ``2 ** bits`` bits in rows of 4 KB, so what is broadcast has a fixed size (16 MB
by default) however many there are, no text is shuffled, and a length that most rows have meets nobody's task. A bit that two groups share
only means that a text is hashed needlessly: its full hash decides. 

Group sizes are counted by partial aggregation and written; rows then meet their group's line in one join on the hash, which is a broadcast if the
groups are few; else adaptive execution splits a group that holds most rows. Rows that are alone do not take part.

Everything is DataFrame functions. ``docs`` is read twice and must give the same rows both times, as a stored table does.

Nulls and edges: a null text equals the empty one; of rows that repeat doc_id and text exactly one stays; a null doc_id is smaller than any
other; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.plans.session import written

PREFIX = 64
BITS = 27
ROW_BITS = 15  # bits of one row of bitmap_construct_agg


def spot_of(*columns: str, bits: int) -> Column:
    """The bit of a group."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << bits))


def bitmap_of(groups: DataFrame, spot: Column) -> DataFrame:
    """Rows (part, bitmap) with the bits of all groups."""
    return groups.select(spot.alias("spot")).groupBy(F.shiftright("spot", ROW_BITS).alias("part")).agg(
        F.bitmap_construct_agg(F.col("spot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("bitmap")
    )


def with_mark(rows: DataFrame, bitmap: DataFrame, spot: Column) -> DataFrame:
    """``rows`` with ``shared``: whether the bit of their group is set."""
    bit = spot.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    byte = F.conv(F.hex(F.substring("bitmap", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    shared = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    found = rows.withColumn("part", F.shiftright(spot, ROW_BITS)).join(F.broadcast(bitmap), "part", "left")
    return found.withColumn("shared", shared).drop("part", "bitmap")


def more_than_one(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)


def shared_prefixes(shapes: DataFrame, bits: int) -> DataFrame:
    """Bitmap of the pairs of length and prefix hash that occur more than once among ``shapes`` (length, prefix)."""
    lengths = bitmap_of(more_than_one(shapes, "length"), spot_of("length", bits=bits))
    rest = with_mark(shapes, lengths, spot_of("length", bits=bits)).where("shared")
    return bitmap_of(more_than_one(rest, "length", "prefix"), spot_of("length", "prefix", bits=bits))


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest: bool = False, bits: int = BITS) -> DataFrame:
    """Per row: id, ``keep_id`` (largest id among equal texts), ``group_size`` and ``kept``.

    With ``digest`` also ``text_sha256`` of every text; that reads every text whole, beside the refinement, which then only decides equality.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    shape = [F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix")]
    survivors = shared_prefixes(written(docs.select(*shape), "shapes"), bits)

    rows = docs.select(F.col(id_column).alias("id"), text.alias("whole"), *shape)
    rows = with_mark(rows, survivors, spot_of("length", "prefix", bits=bits))
    hashed = F.when(F.col("shared"), F.sha2("whole", 256))
    columns = ["id", "length", hashed.alias("full_hash"), *([F.sha2("whole", 256).alias("text_sha256")] if digest else [])]
    thin = written(rows.select(*columns, F.monotonically_increasing_id().alias("row_no")), "hashed")

    place = F.struct("id", "row_no")
    groups = written(
        thin.where("full_hash IS NOT NULL").groupBy("full_hash", "length")
        .agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("last")).where("n > 1"),
        "copies",
    )
    found = thin.where("full_hash IS NOT NULL").join(groups, ["full_hash", "length"], "left")
    alone = thin.where("full_hash IS NULL").withColumns({"n": F.lit(None).cast("long"), "last": F.lit(None).cast(groups.schema["last"].dataType)})
    in_group = F.col("n").isNotNull()
    return found.unionByName(alone).select(
        F.col("id").alias(id_column),
        F.when(in_group, F.col("last.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (~in_group | (F.col("row_no") == F.col("last.row_no"))).alias("kept"),
        *(["text_sha256"] if digest else []),
    )
