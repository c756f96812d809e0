"""Dispensing against limited stock: decide a whole batch of commands at once.

One at a time, a command is granted when the stock still covers it, and a refused command
uses nothing. That depends on order, so a running sum is wrong. Two exact ways are used:

* A key (hospital and drug) with few commands is folded: its commands, sorted, are walked
  by one ``aggregate`` expression.
* A key with many commands is decided in rounds, none of which gathers the key in a task.
  With ``left`` in [2^k, 2^(k+1)), every command below 2^k is granted until ``left`` falls
  under 2^k, at most one command of 2^k or more can be granted before that happens, and
  larger ones are refused. A round finds, by distributed running totals, the first command
  that takes ``left`` under 2^k. Stock is a 32-bit number: there are at most 31 rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.plans.numbering import in_ranges, running_total
from carelake.plans.session import written

KEYS = ["hospital_id", "drug_id"]
FOLD_LIMIT = 1000


def folded_decisions(commands: DataFrame) -> DataFrame:
    """Walk each key's commands in order; ``commands`` has keys, seq, quantity, stock."""
    start = F.struct(
        F.col("stock").cast("bigint").alias("left"),
        F.array().cast("array<struct<seq:bigint,granted:boolean,remaining_stock:bigint>>").alias("done"),
    )

    def step(state: Column, command: Column) -> Column:
        granted = command["quantity"] <= state["left"]
        left = F.when(granted, state["left"] - command["quantity"]).otherwise(state["left"])
        entry = F.struct(
            command["seq"].alias("seq"), granted.alias("granted"), left.alias("remaining_stock")
        )
        return F.struct(left.alias("left"), F.concat(state["done"], F.array(entry)).alias("done"))

    listed = commands.groupBy(*KEYS, "stock").agg(
        F.sort_array(F.collect_list(F.struct("seq", F.col("quantity").cast("bigint").alias("quantity")))).alias("list")
    )
    walked = listed.select(*KEYS, F.explode(F.aggregate("list", start, step)["done"]).alias("d"))
    return walked.select(*KEYS, "d.seq", "d.granted", "d.remaining_stock")


def one_round(ranged: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """State after the keys with ``left`` in [2^k, 2^(k+1)) went below 2^k or ran out of commands."""
    low, high = 1 << k, 1 << (k + 1)
    active = F.col("left") >= low
    open_rows = (
        ranged.join(state.filter(active).select(*KEYS, "left", "after"), KEYS)
        .filter((F.col("seq") > F.col("after")) & (F.col("quantity") < high))
    )
    small = F.col("quantity") < low
    summed = running_total(open_rows, KEYS, "seq", F.when(small, F.col("quantity")).otherwise(0), "spent")
    rest = F.col("left") - F.col("spent")
    ends = F.when(small, rest < low).otherwise(F.col("quantity") <= rest)
    new_left = F.when(small, rest).otherwise(rest - F.col("quantity"))
    first = (
        summed.filter(ends)
        .groupBy(*KEYS)
        .agg(F.min(F.struct("seq", new_left.alias("left"), (~small).alias("large"))).alias("end"))
    )
    # A key that never ends its round grants every later small command: it is finished.
    end_seq = F.coalesce(F.col("end.seq"), F.lit((1 << 63) - 1))
    segment = F.struct(
        F.lit(low).cast("bigint").alias("below"),
        F.col("after"),
        end_seq.alias("until"),
        F.coalesce(F.col("end.large"), F.lit(False)).alias("large"),
    )
    joined = state.join(first, KEYS, "left")
    return joined.select(
        *KEYS,
        F.when(active, F.coalesce(F.col("end.left"), F.lit(0))).otherwise(F.col("left")).cast("bigint").alias("left"),
        F.when(active, end_seq).otherwise(F.col("after")).alias("after"),
        F.when(active, F.array_append("segments", segment)).otherwise(F.col("segments")).alias("segments"),
    )


def round_decisions(commands: DataFrame) -> DataFrame:
    """Decide keys with any number of commands by rounds over halving stock levels."""
    ranged = in_ranges(commands, *KEYS, "seq")
    state = ranged.groupBy(*KEYS).agg(F.max("stock").cast("bigint").alias("left")).select(
        *KEYS, "left", F.lit(-(1 << 63)).cast("bigint").alias("after"),
        F.array().cast("array<struct<below:bigint,after:bigint,until:bigint,large:boolean>>").alias("segments"),
    )
    state = written(state, "stock-state")
    while highest := state.agg(F.max("left")).first()[0]:
        state = written(one_round(ranged, state, highest.bit_length() - 1), "stock-state")

    def grants(segment: Column) -> Column:
        inside = (F.col("seq") > segment["after"]) & (F.col("seq") <= segment["until"])
        small = F.col("quantity") < segment["below"]
        return inside & (small | (segment["large"] & (F.col("seq") == segment["until"])))

    decided = ranged.join(state.select(*KEYS, "segments"), KEYS).withColumn(
        "granted", F.exists("segments", grants)
    )
    decided = running_total(
        decided, KEYS, "seq", F.when(F.col("granted"), F.col("quantity")).otherwise(0), "spent"
    )
    return decided.select(
        *KEYS, "seq", "granted", (F.col("stock") - F.col("spent")).cast("bigint").alias("remaining_stock")
    )


def decide(commands: DataFrame, fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """``granted`` and ``remaining_stock`` for every command (keys, seq, quantity > 0, stock)."""
    crowded = (
        commands.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fold_limit)
        .select(*KEYS, F.lit(True).alias("crowded"))
    )
    marked = written(commands.join(crowded, KEYS, "left"), "marked-commands")
    few = folded_decisions(marked.filter(F.col("crowded").isNull()))
    many = marked.filter(F.col("crowded")).drop("crowded")
    return few if many.isEmpty() else few.unionByName(round_decisions(many))
