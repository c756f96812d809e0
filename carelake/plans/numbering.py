"""Global order without a global task: positions and running totals over any number of rows.

A window without a partition, or over one key that holds most rows, sorts everything in one
task. Here rows are range-partitioned by the order, numbered inside each partition, and
only one row per partition (its size or total) is ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.plans.session import written

# monotonically_increasing_id() is the partition number in the upper bits, the row in the lower.
ROW_BITS = 33


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``range_no`` (its slice of the order) and ``range_row`` (0-based, inside it).

    The order must be unique. The result is written, so that both numbers are fixed: every
    later read sees the same slices, whatever happens to an executor.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("place", F.monotonically_increasing_id())
    return written(
        ranged.select(
            *df.columns,
            F.shiftright("place", ROW_BITS).alias("range_no"),
            F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("range_row"),
        ),
        "ranges",
    )


def with_position(df: DataFrame, *order: str, position: str = "position") -> DataFrame:
    """``df`` with the 1-based place of each row in the global order."""
    ranged = in_ranges(df, *order)
    sizes = ranged.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    # One row per range, at most as many as there are shuffle partitions.
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (
        ranged.join(F.broadcast(offsets), "range_no")
        .withColumn(position, F.col("offset") + F.col("range_row") + 1)
        .drop("range_no", "range_row", "offset")
    )


def running_total(ranged: DataFrame, keys: list[str], order: str, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the rows of the same key up to and including each row.

    ``ranged`` comes from ``in_ranges`` over the keys and the order. A key is summed slice
    by slice; what earlier slices add up to is joined on afterwards. The explicit partitioning
    matters when the rows come from a join on the keys, which leaves a key in one partition.
    """
    slices = [*keys, "range_no"]
    rows = ranged.withColumn("amount_", amount).repartition(*slices)
    inside = Window.partitionBy(*slices).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy(*slices).agg(F.sum("amount_").alias("total_"))
    before = Window.partitionBy(*keys).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*slices, F.coalesce(F.sum("total_").over(before), F.lit(0)).alias("offset_"))
    return (
        rows.withColumn("inside_", F.sum("amount_").over(inside))
        .join(offsets, slices)
        .withColumn(name, F.col("inside_") + F.col("offset_"))
        .drop("amount_", "inside_", "offset_")
    )
