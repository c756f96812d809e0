"""The core store: one Parquet folder per table, months as partitions, whole-table versions.

Inserts append to the current version of a table. An update of a table stored by month overwrites the touched months
only (dynamic partition overwrite); an update of another table writes a whole new version beside the old one, which counts
only once its ``_SUCCESS`` marker is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.core import Core
from carelake.functions.figures import month_of
from carelake.functions.text import number_in
from carelake.plans.session import written
from carelake.schemas import BY_NAME, TABLES, Table

LOG = "etl/error_log"
LOG_SCHEMA = T.StructType(
    [
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("source_key", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("raw_data", T.StringType()),
    ]
)
LOADS = "etl/load_log"
LOADS_SCHEMA = T.StructType(
    [
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("target_table", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("staged", "accepted", "quarantined", "known", "pending")],
    ]
)
BATCHES = "etl/batches"
NUMBERS = "etl/numbers"


def core_schema(table: Table) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c.name} {c.type}" for c in table.columns))


def in_months_of(rows: DataFrame, table: Table) -> Column:
    """Whether a stored row lies in a month that ``rows`` have; rows without a date lie together. The months are few and literal, so
    Spark skips the folders of all others."""
    months = {r.ym for r in rows.select(month_of(table.month_of).alias("ym")).distinct().collect()}
    dated = F.col("ym").isin(sorted(months - {None}))
    return dated | F.col("ym").isNull() if None in months else dated


@dataclass
class Appended:
    """What one append wrote, counted while it was written."""

    rows: int
    largest: int | None


class CoreStore:
    """Core tables under one root folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # Folders and markers

    def _folder(self, path: str):
        """The Hadoop path and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        folder, files = self._folder(path)
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []

    def _mark(self, path: str) -> None:
        marker, files = self._folder(path)
        files.create(marker, True).close()

    def _drop(self, path: str) -> None:
        folder, files = self._folder(path)
        files.delete(folder, True)

    def _versions(self, table: Table) -> list[int]:
        base = f"{self.root}/{table.schema}/{table.name}"
        versions = [n for n in self._names(base) if n.startswith("v=")]
        return sorted(int(n[2:]) for n in versions if "_SUCCESS" in self._names(f"{base}/{n}"))

    def _path(self, table: Table, version: int) -> str:
        return f"{self.root}/{table.schema}/{table.name}/v={version}"

    # Tables

    def read(self, name: str) -> DataFrame:
        table = BY_NAME[name]
        schema = core_schema(table)
        if table.month_of:
            schema = schema.add("ym", T.StringType())
        versions = self._versions(table)
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(table, versions[-1]))

    def _write(self, table: Table, rows: DataFrame, version: int, mode: str, dynamic: bool = False) -> Appended:
        """Write the rows and count them in the tasks that write, which succeed once each."""
        rows = rows.select(*table.column_names)
        lookup = table.looked_up_by
        if table.month_of:
            # REBALANCE gathers a month into few files and splits a month that is too big.
            rows = rows.withColumn("ym", month_of(table.month_of)).hint("rebalance", "ym")
        elif lookup:
            rows = rows.repartitionByRange(lookup)
        if lookup:
            # Rows of a patient, visit or prescription lie together: row groups hold narrow ranges of it.
            rows = rows.sortWithinPartitions(*(["ym"] if table.month_of else []), lookup)
        seen, measures = Observation(), [F.count(F.lit(1)).alias("rows")]
        if table.numbered:
            measures.append(F.max(number_in(table.key, table.numbered)).alias("largest"))
        writer = rows.observe(seen, *measures).write.mode(mode).option("compression", "zstd")
        if lookup:
            writer = writer.options(**{f"parquet.bloom.filter.enabled#{lookup}": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if table.month_of:
            writer = writer.partitionBy("ym")
        writer.parquet(self._path(table, version))
        found = seen.get
        return Appended(found["rows"], found.get("largest"))

    def append(self, name: str, rows: DataFrame) -> Appended:
        table = BY_NAME[name]
        versions = self._versions(table)
        version = versions[-1] if versions else 0
        if not table.numbered:
            return self._write(table, rows, version, "append")
        known = self.largest(name)  # before the write, so that it need not look at the new rows
        opened = f"{self.root}/{NUMBERS}/{name}/open-{uuid.uuid4().hex}"
        self._mark(opened)
        found = self._write(table, rows, version, "append")
        self._keep_largest(name, max(known, found.largest or 0))
        self._drop(opened)
        return found

    def replace(self, name: str, rows: DataFrame) -> None:
        table = BY_NAME[name]
        versions = self._versions(table)
        self._write(table, rows, versions[-1] + 1 if versions else 0, "overwrite")

    def update(self, name: str, rows: DataFrame) -> None:
        """Stored rows with the keys of ``rows`` take their values.

        A table stored by month is rewritten only in the months of ``rows``, which keep their month; files of other months stay as
        they are. Doing it twice gives the same table.
        """
        table = BY_NAME[name]
        rows = written(rows.select(*table.column_names), f"update-{name}")
        stored = self.read(name)
        if not table.month_of:
            rest = stored.join(rows.select(table.key), table.key, "left_anti")
            self.replace(name, rest.unionByName(rows))
            return
        if rows.isEmpty():
            return
        rest = stored.filter(in_months_of(rows, table)).drop("ym").join(rows.select(table.key), table.key, "left_anti")
        self._write(table, rest.unionByName(rows), self._versions(table)[-1], "overwrite", dynamic=True)

    # Numbers given out

    def largest(self, name: str) -> int:
        """The largest number among the keys of a table, 0 without any.

        It is kept with every append as the name of a marker. An append that broke off leaves its own marker open; then, and for tables
        older than the markers, the keys are looked through once and the result is kept.
        """
        table, base = BY_NAME[name], f"{self.root}/{NUMBERS}/{name}"
        markers = self._names(base)
        opened = [m for m in markers if m.startswith("open-")]
        kept = [int(m.removeprefix("max-")) for m in markers if m.startswith("max-")]
        if kept and not opened:
            return max(kept)
        found = self.read(name).agg(F.max(number_in(table.key, table.numbered))).first()[0] if self._versions(table) else None
        largest = max([found or 0, *kept])
        self._keep_largest(name, largest)
        for marker in opened:
            self._drop(f"{base}/{marker}")
        return largest

    def _keep_largest(self, name: str, largest: int) -> None:
        self._mark(f"{self.root}/{NUMBERS}/{name}/max-{largest}")

    # Command batches

    def batch_folder(self, batch: str) -> str:
        return f"{self.root}/{BATCHES}/{batch}"

    def batch_state(self, batch: str) -> str | None:
        """None, ``decided`` (its rows are stored) or ``applied``."""
        markers = self._names(self.batch_folder(batch))
        return next((state for state in ("applied", "decided") if state in markers), None)

    def mark_batch(self, batch: str, state: str) -> None:
        self._mark(f"{self.batch_folder(batch)}/{state}")

    def batch_tables(self, batch: str, part: str) -> list[str]:
        return sorted(self._names(f"{self.batch_folder(batch)}/{part}"))

    # Logs

    def _log(self, path: str, rows: DataFrame, schema: T.StructType, label: str) -> None:
        # A folder for each table, so that tables which load side by side do not write into one folder.
        rows.select(*schema.fieldNames()).write.mode("append").parquet(f"{self.root}/{path}/{label}", compression="zstd")

    def _read_log(self, path: str, schema: T.StructType) -> DataFrame:
        if not self._names(f"{self.root}/{path}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/{path}")

    def log(self, rows: DataFrame, label: str = "all") -> int:
        """Append to the error log; returns the number of rows."""
        seen = Observation()
        self._log(LOG, rows.observe(seen, F.count(F.lit(1)).alias("rows")), LOG_SCHEMA, label)
        return seen.get["rows"]

    def error_log(self) -> DataFrame:
        return self._read_log(LOG, LOG_SCHEMA)

    def log_load(self, row: Sequence, label: str) -> None:
        self._log(LOADS, self.spark.createDataFrame([tuple(row)], LOADS_SCHEMA).coalesce(1), LOADS_SCHEMA, label)

    def load_log(self) -> DataFrame:
        """One row per table and load, counted while the load ran."""
        return self._read_log(LOADS, LOADS_SCHEMA)

    def core(self) -> Core:
        """The tables as they are now; take a new one after a write."""
        return Core(self.spark, {t.name: (lambda n=t.name: self.read(n)) for t in TABLES}, self.largest)
