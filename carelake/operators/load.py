"""Validated load: staged text rows become core rows or quarantine rows, never neither.

Every staged row gets one outcome:

``good``      all rules hold; it is accepted into the core table
``rejected``  at least one rule fails; it is quarantined with every reason
``known``     its key is already in the core table; it is left alone, so reruns add nothing
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import moment
from carelake.functions.text import folded, parsed
from carelake.plans.session import discard, free_shuffles, written_at
from carelake.schemas import TABLES, Col, Table
from carelake.sources.store import LOG_SCHEMA, CoreStore
from carelake.sources.text_files import read_delimited, readable, unreadable

logger = logging.getLogger(__name__)

QUARANTINE = ["target_table", "source_key", "reasons", "raw_data"]
STAGED = "s_"  # prefix of the raw text columns while a row is being judged


def staged_value(column: Col) -> Column:
    text = F.col(STAGED + column.name)
    return F.regexp_replace(text, "(?i),|EGP", "") if column.currency else text


def core_value(column: Col, table: Table) -> Column:
    """The value the core table would store; NULL when it cannot be read."""
    text = staged_value(column)
    if column.name in table.key_columns:
        return F.nullif(folded(text), F.lit(""))  # a key of blanks equals the empty text, which is no key
    if column.via:
        text = parsed(text, "decimal(18,0)").try_cast(column.via).cast("string")
    elif column.type != "string":
        return parsed(text, column.type)
    if column.domain:
        spellings = F.create_map(*[F.lit(x) for v in column.domain for x in (v.upper(), v)])
        return spellings[folded(text)]
    return F.coalesce(text, F.lit(column.default)) if column.default else text


def column_reasons(column: Col, table: Table, check_widths: bool) -> list[Column]:
    """One expression per rule of the column: its code when broken, else NULL."""
    name, text, value = column.name, F.col(STAGED + column.name), F.col(column.name)
    rules = []
    if column.required and not column.default:
        rules.append(((value if column.name in table.key_columns else text).isNull(), "null"))
    if (column.type != "string" or column.via) and not column.soft and not column.domain:
        rules.append((text.isNotNull() & value.isNull(), "cast"))
    bounds = [value < F.expr(column.low)] if column.low else []
    bounds += [value > F.expr(column.high)] if column.high else []
    if bounds:
        rules.append((reduce(Column.__or__, bounds), "range"))
    if column.domain:
        rules.append((text.isNotNull() & value.isNull(), "domain"))
    if check_widths and column.width:
        rules.append((F.length(F.rtrim(value if column.via else text)) > column.width, "length"))
    return [F.when(broken, F.lit(f"{code}:{name}")) for broken, code in rules]


def row_reasons(table: Table) -> list[Column]:
    """One expression per rule that looks at several columns of a row."""
    rules = []
    if table.differ:
        left, right = table.differ
        rules.append((F.col(left) == F.col(right), "check:from_to"))
    if table.one_of:
        left, right = table.one_of
        rules.append((F.col(left).isNull() == F.col(right).isNull(), "check:xor"))
    return [F.when(broken, F.lit(code)) for broken, code in rules]


def key_rules(table: Table) -> list[tuple[str, str]]:
    """The rules that need other rows, as the flag that says whether one is broken and its code."""
    rules = [("missing_" + ref.column, ref.reason) for ref in table.refs]
    return rules + [("taken_" + names[0], "unique:" + "+".join(names)) for names in table.uniques]


def numbered_text(staged: DataFrame, table: Table) -> DataFrame:
    """Staged text under ``STAGED`` names and a number for each row."""
    return staged.select(
        *[F.nullif(F.col(c), F.lit("")).alias(STAGED + c) for c in table.column_names],
        F.monotonically_increasing_id().alias("row_no"),
    )


def with_core_values(text: DataFrame, table: Table, names: set[str] | None = None) -> DataFrame:
    """Numbered text with the core values beside it, all or those of some columns."""
    return text.withColumns({c.name: core_value(c, table) for c in table.columns if names is None or c.name in names})


def kept_as_read(column: Col, table: Table) -> bool:
    """Whether the core value is the staged text itself."""
    changed = column.type != "string" or column.via or column.domain or column.default or column.currency
    return not changed and column.name not in table.key_columns


def once_read(staged: DataFrame, table: Table, check_widths: bool) -> DataFrame:
    """Staged rows with every text read once: the core values, the codes of the rules broken within the row (``broken``, NULL for none) and
    a number for each row.

    The text itself is kept under its ``STAGED`` name where the core value does not spell it, and for a column with a default.
    """
    rows = with_core_values(numbered_text(staged, table), table)
    raw = []
    for c in table.columns:
        if not kept_as_read(c, table):
            text = F.col(STAGED + c.name)
            spelled = F.lit(False) if c.default else text == F.col(c.name).cast("string")
            raw.append(F.when(spelled, F.lit(None)).otherwise(text).alias(STAGED + c.name))
    broken = [r for c in table.columns for r in column_reasons(c, table, check_widths)] + row_reasons(table)
    return rows.select(*table.column_names, *raw, F.nullif(F.concat_ws(",", *broken), F.lit("")).alias("broken"), "row_no")


def as_staged(column: Col, table: Table) -> Column:
    """The text a row of ``once_read`` was staged with; the empty text is NULL."""
    if kept_as_read(column, table):
        return F.col(column.name)
    text = F.col(STAGED + column.name)
    return text if column.default else F.coalesce(text, F.col(column.name).cast("string"))


def key_findings(batch: DataFrame, table: Table, core: Core) -> DataFrame:
    """What is to be said about the batch's keys: rows (kind, key_0, key_1), one per value.

    ``missing:<column>`` a reference without a parent, ``known`` a key the core has, ``taken:<columns>`` a unique
    value it has, ``repeat:<columns>`` that several rows of the batch seem to hold one key or unique value (one row, no values).
    Only distinct keys are compared with the stored tables. The stored side is reduced to them first, so a small batch is broadcast
    past the core table, which is then neither shuffled nor sorted; for a large one both sides are shuffled by key, as keys only.

    Of the batch's own keys, normally one a row, only 64-bit hashes are shuffled, once. What two keys with one hash could do is
    harmless: a stored key that no row holds meets no row when the rows are joined with the findings by value, and
    rows said to repeat a key are counted by value before anything is refused.
    """

    def keys(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        return rows.select(*[F.col(n).alias(f"key_{i}") for i, n in enumerate(names)]).dropna()

    def hashed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("key_hash", F.xxhash64(*[F.col(c).cast("string") for c in rows.columns]))

    def rows_of(kind: str, found: DataFrame) -> DataFrame:
        second = F.col("key_1").cast("string") if "key_1" in found.columns else F.lit(None).cast("string")
        return found.select(F.lit(kind).alias("kind"), F.col("key_0").cast("string").alias("key_0"), second.alias("key_1"))

    parts = []
    for ref in table.refs:
        wanted = keys(batch, [ref.column]).distinct()
        present = keys(core[ref.table], [ref.key]).join(wanted, "key_0", "left_semi")
        parts.append(rows_of("missing:" + ref.column, wanted.join(present, "key_0", "left_anti")))
    stored = core[table.name] if table.name in core else None
    for names in ((table.key,), *table.uniques):
        counted = hashed(keys(batch, names)).groupBy("key_hash").agg(F.count(F.lit(1)).alias("copies"))
        label = "+".join(names)
        if stored is not None:
            kind = "known" if names == (table.key,) else "taken:" + label
            # The count stays in use, so that Spark reuses the one shuffle.
            held = counted.filter("copies > 0").select("key_hash")
            parts.append(rows_of(kind, hashed(keys(stored, names)).join(held, "key_hash", "left_semi").distinct()))
        most = counted.agg(F.max("copies").alias("copies")).filter("copies > 1")
        parts.append(rows_of("repeat:" + label, most.select(F.lit(None).cast("string").alias("key_0"))))
    return reduce(DataFrame.unionByName, parts)


def with_findings(rows: DataFrame, found: DataFrame, kinds: set[str], kind: str, names: Sequence[str], flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether their values are among the findings of a kind. Nothing is joined where there are none."""
    if kind not in kinds:
        return rows.withColumn(flag, F.lit(False))
    columns = [F.col(f"key_{i}").alias(f"f_{n}") for i, n in enumerate(names)]
    values = found.filter(F.col("kind") == kind).select(*columns, F.lit(True).alias(flag))
    same = reduce(Column.__and__, [F.col(n).cast("string") == F.col(f"f_{n}") for n in names])
    return rows.join(values, same, "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop(*[f"f_{n}" for n in names])


@dataclass
class Judged:
    """Every staged row with its core values, reasons and outcome; the kinds of findings; the number of staged rows; the folders
    of what was written for it."""

    rows: DataFrame
    kinds: set[str]
    staged: int
    folders: tuple[str, ...]


def judge(staged: DataFrame, table: Table, core: Core, check_widths: bool = True, keep_raw: bool = False) -> Judged:
    """Every staged row with its core values, its reasons and its outcome.

    The batch is written once, with its text already read, so later steps parse nothing. Its distinct keys are compared with the stored
    tables and what is amiss, normally few keys, is written as well, so its size is known: the batch then meets small broadcast tables,
    or none, and is itself neither shuffled nor sorted. (Should many keys be amiss, Spark joins by sorting, and adaptive execution
    splits a key that dominates; what it then shuffles is the written rows.) The JSON snapshot is made for rejected rows only.
    """
    count = Observation()
    batch = once_read(staged, table, check_widths).observe(count, F.count(F.lit(1)).alias("rows"))
    rows, text_folder = written_at(batch, f"staged-{table.name}", "zstd")
    found, found_folder = written_at(key_findings(rows, table, core), f"findings-{table.name}", "zstd")
    kinds = {r.kind for r in found.select("kind").distinct().collect()}  # at most one a rule

    for ref in table.refs:
        rows = with_findings(rows, found, kinds, "missing:" + ref.column, [ref.column], "missing_" + ref.column)
    rows = with_findings(rows, found, kinds, "known", [table.key], "is_known")
    for names in table.uniques:
        rows = with_findings(rows, found, kinds, "taken:" + "+".join(names), names, "taken_" + names[0])

    rules = key_rules(table)
    amiss = reduce(Column.__or__, [F.col(flag) for flag, _ in rules], F.col("broken").isNotNull())
    outcome = F.when(F.col("is_known"), "known").when(amiss, "rejected").otherwise("good")
    codes = F.concat_ws(",", "broken", *[F.when(F.col(flag), F.lit(code)) for flag, code in rules])
    snapshot = F.to_json(F.struct(*[as_staged(c, table).alias(c.name) for c in table.columns]), {"ignoreNullFields": "false"})
    wanted = F.lit(True) if keep_raw else F.col("outcome") == "rejected"
    rows = rows.withColumn("outcome", outcome).select(
        *table.column_names,
        as_staged(table.columns[0], table).alias("source_key"),
        F.when(amiss, F.split(codes, ",")).otherwise(F.array().cast("array<string>")).alias("reasons"),
        F.when(wanted, snapshot).alias("raw_data"),
        "row_no",
        "outcome",
    )
    return Judged(rows, kinds, count.get["rows"], (text_folder, found_folder))


def judged(staged: DataFrame, table: Table, core: Core, check_widths: bool = True, keep_raw: bool = False) -> DataFrame:
    return judge(staged, table, core, check_widths, keep_raw).rows


def repeated(good: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Key values held by more than one row of the batch, with the first such row.

    A plain aggregation: partial counts are made before the shuffle, so a value that fills
    a third of the batch costs one row per task.
    """
    return (
        good.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min("row_no").alias("first_row"))
        .filter("copies > 1")
    )


@dataclass
class LoadResult:
    table: Table
    judged: DataFrame
    accepted: DataFrame
    quarantined: DataFrame
    failed: bool
    staged: int  # rows of the batch
    repeats: bool  # several rows of the batch may hold one key
    folders: tuple[str, ...]  # what was written to judge the batch

    def discard(self) -> None:
        """Delete what was written to judge the batch, once nothing of this result is read any more."""
        for folder in self.folders:
            discard(self.judged.sparkSession, folder)

    def counts(self) -> DataFrame:
        """One row: accepted, rejected, known."""
        parts = {
            "accepted": self.accepted,
            "rejected": self.quarantined,
            "known": self.judged.filter(F.col("outcome") == "known"),
        }
        labels = [part.select(F.lit(name).alias("part")) for name, part in parts.items()]
        return (
            reduce(DataFrame.unionByName, labels)
            .groupBy()
            .agg(*[F.count(F.when(F.col("part") == name, 1)).alias(name) for name in parts])
            .select(F.lit(self.table.full_name).alias("target_table"), *parts)
        )


def validated_load(
    staged: DataFrame,
    table: Table,
    core: Core,
    on_duplicate: str = "fail",
    check_widths: bool = True,
) -> LoadResult:
    """Judge one staged table against the current core tables.

    ``on_duplicate`` decides about a key that occurs twice among the rows that are otherwise
    good: ``fail`` accepts nothing and reports the table once, ``first`` keeps the earliest
    row and quarantines the others.
    """
    if on_duplicate not in ("fail", "first"):
        raise ValueError(on_duplicate)
    spark = staged.sparkSession
    found = judge(staged, table, core, check_widths, keep_raw=on_duplicate == "first")
    rows = found.rows
    good = rows.filter(F.col("outcome") == "good")
    rejected = rows.filter(F.col("outcome") == "rejected")
    target = F.lit(table.full_name).alias("target_table")
    quarantined = rejected.select(target, *QUARANTINE[1:])
    failed = False

    for keys in ((table.key,), *table.uniques):
        if "repeat:" + "+".join(keys) not in found.kinds:
            continue
        twice = repeated(good, keys)
        if twice.isEmpty():
            continue
        code = ("duplicate:" if keys == (table.key,) else "unique:") + "+".join(keys)
        if on_duplicate == "fail":
            failed = True
            report = spark.createDataFrame([(table.full_name, None, [code], None)], quarantined.schema)
            quarantined = quarantined.unionByName(report)
            good = good.limit(0)
            break
        marked = good.join(twice, list(keys), "left")
        later = F.coalesce(F.col("row_no") > F.col("first_row"), F.lit(False))
        losers = marked.filter(later)
        quarantined = quarantined.unionByName(
            losers.select(target, "source_key", F.array(F.lit(code)).alias("reasons"), "raw_data")
        )
        good = marked.filter(~later).drop("copies", "first_row")
    repeats = f"repeat:{table.key}" in found.kinds
    return LoadResult(table, rows, good.select(*table.column_names), quarantined, failed, found.staged, repeats, found.folders)


def load_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: Table,
    core: Core,
    load_time: datetime,
    on_duplicate: str = "fail",
    **options,
) -> LoadResult:
    """Delivered files straight into a core table, under the same rules as a staged load.

    ``options`` go to ``read_delimited`` (separator, quoting). Lines with the wrong number
    of fields join the quarantine.
    """
    staged = read_delimited(spark, paths, table, load_time, **options)
    result = validated_load(readable(staged), table, core, on_duplicate)
    result.quarantined = result.quarantined.unionByName(unreadable(staged, table))
    return result


def load_table(
    staged: DataFrame, table: Table, store: CoreStore, load_time: datetime, on_duplicate: str, check_widths: bool
) -> None:
    """Load one table and log what became of its rows; the numbers are counted by the jobs that write them."""
    core = store.core()
    result = validated_load(staged, table, core, on_duplicate, check_widths)
    accepted = 0 if result.failed else store.append(table.name, result.accepted).rows
    quarantined = store.log(result.quarantined.withColumn("load_timestamp", moment(load_time)), table.name)
    if result.failed or result.repeats:
        # A key that several rows hold: whether it arrived says more than how many rows did.
        key = F.col("waiting_key")
        arrived = store.read(table.name).select(F.col(table.key).alias("waiting_key"))
        waiting = result.judged.select(F.col(table.key).alias("waiting_key")).join(arrived, "waiting_key", "left_anti")
        known = result.judged.filter(F.col("outcome") == "known").count()
        pending = waiting.agg(F.count(F.coalesce(key, F.lit("")))).first()[0]
    else:
        # Every row is accepted, rejected or known, and no two of them share a key.
        known = result.staged - accepted - quarantined
        pending = quarantined
    store.log_load((load_time, table.full_name, result.staged, accepted, quarantined, known, pending), table.name)
    result.discard()


def load_all(
    staging: Mapping[str, DataFrame | Callable[[], DataFrame]],
    store: CoreStore,
    load_time: datetime,
    on_duplicate: str = "fail",
    check_widths: bool = True,
    side_by_side: int = 6,
    done: Callable[[str], None] | None = None,
) -> None:
    """Load every staged table after the tables it refers to; a table that fails does not stop the others.

    Tables without a reference between them load side by side, each under a job group of its name. A staged table may be
    given as a function that delivers it, called when its turn comes; ``done`` is called with its name after its load, and may delete
    what was delivered. So the intermediates of all tables never lie on disk together.
    """
    started: dict[str, Future] = {}

    def run(table: Table, parents: list[Future]) -> None:
        wait(parents)
        store.spark.sparkContext.setJobGroup(f"load {table.full_name}", f"load of {table.full_name}")
        given = staging[table.name]
        staged = given if isinstance(given, DataFrame) else given()
        try:
            load_table(staged, table, store, load_time, on_duplicate, check_widths)
        except Exception as error:  # noqa: BLE001 - the failure unit is the table
            logger.warning("load of %s failed: %s", table.full_name, error)
            row = [(load_time, table.full_name, None, [f"error:{type(error).__name__}"], str(error))]
            logged = store.log(store.spark.createDataFrame(row, LOG_SCHEMA), table.name)
            store.log_load((load_time, table.full_name, None, None, logged, None, None), table.name)
        if done:
            done(table.name)
        free_shuffles(store.spark)

    with ThreadPoolExecutor(side_by_side) as pool:
        for table in TABLES:  # parents come first, so a table never waits for one that has no thread yet
            if table.name in staging:
                parents = [started[r.table] for r in table.refs if r.table in started]
                started[table.name] = pool.submit(inheritable_thread_target(store.spark)(run), table, parents)
    for load in started.values():
        load.result()
