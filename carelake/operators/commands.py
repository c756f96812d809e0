"""Business commands as batches: a table of commands in, decisions and new rows out.

``seq`` is unique and gives the order; the outcome of every row is what calling the
commands one by one in that order would give. Decisions are written before ids are given
out, so they are made once, and ids come from ``with_position``, not from a global window.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.text import folded, number_in, numbered
from carelake.operators.dispensing import FOLD_LIMIT, decide
from carelake.plans.numbering import with_position
from carelake.plans.session import written
from carelake.schemas import BY_NAME, CLAIM_STATES, VISIT_TYPES
from carelake.sources.store import CoreStore, in_months_of

REVIEW_STATES = ("Approved", "Partially Approved", "Rejected")


@dataclass
class Outcome:
    """One row per command, the rows to add to core tables, and the rows of core tables that take new values."""

    decisions: DataFrame
    added: dict[str, DataFrame] = field(default_factory=dict)
    changed: dict[str, DataFrame] = field(default_factory=dict)

    def apply(self, store: CoreStore, batch: str | None = None) -> None:
        """Store the effects. Ids and decisions are already written, so they stay as decided.

        With the name of a batch the effects are stored under that name first. If applying them breaks off, ``resume`` (or
        ``apply`` once more, whatever it would decide now) finishes what was decided then, and a batch that was applied is left alone.
        """
        if batch is None:
            apply_rows(store, self.added, self.changed)
            return
        if store.batch_state(batch) is None:
            for part, tables in (("added", self.added), ("changed", self.changed)):
                for name, rows in tables.items():
                    rows.write.mode("overwrite").parquet(f"{store.batch_folder(batch)}/{part}/{name}")
            store.mark_batch(batch, "decided")
        resume(store, batch)


def apply_rows(store: CoreStore, added: dict[str, DataFrame], changed: dict[str, DataFrame]) -> None:
    for name, rows in added.items():
        store.append(name, rows)
    for name, rows in changed.items():
        store.update(name, rows)


def resume(store: CoreStore, batch: str) -> None:
    """Apply a decided batch, leaving out what an earlier attempt stored already.

    Added rows are told by their keys, in the months of the batch only; changed rows hold final values, so storing them again
    changes nothing. What is read of a stored table is its key column.
    """
    state = store.batch_state(batch)
    if state is None:
        raise LookupError(f"batch {batch} was not decided")
    if state == "applied":
        return

    def rows_of(part: str, name: str) -> DataFrame:
        return store.spark.read.parquet(f"{store.batch_folder(batch)}/{part}/{name}")

    added = {}
    for name in store.batch_tables(batch, "added"):
        table, rows = BY_NAME[name], rows_of("added", name)
        stored = store.read(name)
        if table.month_of:
            stored = stored.filter(in_months_of(rows, table))
        added[name] = rows.join(stored.select(table.key), table.key, "left_anti")
    apply_rows(store, added, {name: rows_of("changed", name) for name in store.batch_tables(batch, "changed")})
    store.mark_batch(batch, "applied")


def updated(core: Core, outcome: Outcome, name: str) -> DataFrame:
    """A core table as it is after a batch that changes rows of it."""
    rows, key = written(outcome.changed[name], f"changed-{name}", "zstd"), BY_NAME[name].key
    rest = core[name].select(*rows.columns).join(rows.select(key), key, "left_anti")
    return rest.unionByName(rows)


def reason_list(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(code)) for broken, code in rules]))


def spelled(column: str, domain: tuple[str, ...]) -> Column:
    spellings = F.create_map(*[F.lit(x) for v in domain for x in (v.upper(), v)])
    return spellings[folded(column)]


def next_ids(
    rows: DataFrame, order: list[str], taken: DataFrame, id_column: str, prefix: str, digits: int, largest: int | None = None
) -> DataFrame:
    """``rows`` with ``id_column`` = prefix + (largest number in use + place in the order).

    The ids of ``taken`` are looked through for the largest number unless it is given.
    """
    used = taken.select(F.coalesce(F.max(number_in(id_column, prefix)), F.lit(0))).scalar() if largest is None else F.lit(largest)
    placed = with_position(rows, *order)
    placed = placed.withColumn(id_column, numbered(prefix, used + F.col("position"), digits)).drop("position")
    return written(placed, f"new-{id_column}")


def next_keys(rows: DataFrame, order: list[str], core: Core, name: str, digits: int) -> DataFrame:
    """``rows`` with the next keys of a core table; a store keeps the largest number with the table."""
    table = BY_NAME[name]
    return next_ids(rows, order, core[name], table.key, table.numbered, digits, core.largest(name))


def folded_keys(commands: DataFrame, *names: str) -> DataFrame:
    return commands.withColumns({n: folded(n) for n in names})


def split(decided: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The decided commands, written once, as (accepted, rejected)."""
    decided = written(decided, label)
    return decided.filter(F.size("reasons") == 0), decided.filter(F.size("reasons") > 0)


def first_wins(decided: DataFrame, key: str, code: str) -> DataFrame:
    """Of several acceptable commands for one key only the first stays acceptable.

    The first is an aggregate (partial in every task) and finds its command again by the
    unique ``seq``, so a key repeated very often does not meet in one task.
    """
    good = F.size("reasons") == 0
    winners = decided.filter(good).groupBy(key).agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    marked = decided.join(winners, "seq", "left")
    late = good & F.col("first").isNull()
    return marked.withColumn(
        "reasons", F.when(late, F.array(F.lit(code))).otherwise(F.col("reasons"))
    ).drop("first")


def register_visits(core: Core, commands: DataFrame, as_of: date) -> Outcome:
    """New completed visits dated ``as_of`` for known patients, active doctors and own departments."""
    commands = folded_keys(commands, "patient_id", "hospital_id", "doctor_id", "department_id", "diagnosis_code")
    patient = core["patient"].select("patient_id", F.lit(True).alias("has_patient"))
    doctor = core["doctor"].filter(F.col("employment_status") == "Active").select(
        "doctor_id", F.lit(True).alias("has_doctor")
    )
    department = core["department"].select("department_id", "hospital_id", F.lit(True).alias("has_department"))
    diagnosis = core["diagnosis"].select("diagnosis_code", F.lit(True).alias("has_diagnosis"))
    decided = (
        commands.join(patient, "patient_id", "left").join(doctor, "doctor_id", "left")
        .join(department, ["department_id", "hospital_id"], "left").join(diagnosis, "diagnosis_code", "left")
        .withColumn("visit_type", spelled("visit_type", VISIT_TYPES))
        .withColumn("reasons", reason_list(
            (F.col("has_patient").isNull(), "patient:not_found"),
            (F.col("has_doctor").isNull(), "doctor:not_active"),
            (F.col("has_department").isNull(), "department:not_in_hospital"),
            (F.col("visit_type").isNull(), "domain:visit_type"),
            (F.col("has_diagnosis").isNull(), "fk:diagnosis"),
        ))
        .drop("has_patient", "has_doctor", "has_department", "has_diagnosis")
    )
    accepted, rejected = split(decided, "register-visits")
    accepted = next_keys(accepted, ["seq"], core, "visit", 8)
    visits = accepted.select(
        "visit_id", "patient_id", "hospital_id", "doctor_id", "department_id", F.lit(as_of).alias("visit_date"),
        "visit_type", "diagnosis_code", "symptoms", F.lit("Completed").alias("visit_status"),
        F.col("waiting_time").cast("int").alias("waiting_time"),
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
    )
    decisions = accepted.select("seq", "visit_id", "reasons").unionByName(
        rejected.select("seq", F.lit(None).cast("string").alias("visit_id"), "reasons")
    )
    return Outcome(decisions, added={"visit": visits})


def dispense(core: Core, commands: DataFrame, as_of: date, fold_limit: int = FOLD_LIMIT) -> Outcome:
    """Take drugs out of stock in order; a command the stock does not cover takes nothing."""
    commands = folded_keys(commands, "hospital_id", "drug_id").select("seq", "hospital_id", "drug_id", "quantity", "performed_by")
    stock = core["drug_inventory"].select("hospital_id", "drug_id", F.col("quantity_available").alias("stock"))
    known = written(commands.join(stock, ["hospital_id", "drug_id"], "left"), "dispense-commands")
    countable = F.coalesce(F.col("quantity") > 0, F.lit(False))
    in_play = known.filter(F.col("stock").isNotNull() & countable)
    decided = decide(in_play.select("hospital_id", "drug_id", "seq", "quantity", "stock"), fold_limit)
    decided = known.join(decided.select("seq", "granted", "remaining_stock"), "seq", "left").withColumn(
        "reasons", reason_list(
            (F.col("stock").isNull(), "stock:not_found"),
            (F.col("stock").isNotNull() & ~countable, "check:quantity"),
            (~F.col("granted"), "stock:insufficient"),
        )
    )
    accepted, rejected = split(decided, "dispense-decisions")
    numbered_rows = next_keys(accepted, ["seq"], core, "drug_transaction", 7)
    moves = numbered_rows.select(
        "transaction_id", "drug_id", "hospital_id", F.lit("Dispensing").alias("transaction_type"),
        F.col("quantity").cast("int").alias("quantity"), F.lit(as_of).alias("transaction_date"), "performed_by",
    )
    taken = accepted.groupBy("hospital_id", "drug_id").agg(F.sum("quantity").alias("taken"))
    inventory = core["drug_inventory"].join(taken, ["hospital_id", "drug_id"]).select(
        "inventory_id", "hospital_id", "drug_id",
        (F.col("quantity_available") - F.col("taken")).cast("int").alias("quantity_available"), "reorder_level", "expiration_date",
    )
    decisions = numbered_rows.select("seq", "transaction_id", "remaining_stock", "reasons").unionByName(
        rejected.select(
            "seq", F.lit(None).cast("string").alias("transaction_id"),
            F.lit(None).cast("bigint").alias("remaining_stock"), "reasons",
        )
    )
    return Outcome(decisions, added={"drug_transaction": moves}, changed={"drug_inventory": inventory})


def submit_claims(core: Core, commands: DataFrame, as_of: date) -> Outcome:
    """A claim for the amount of a completed visit that has none, with its procedures as items."""
    commands = folded_keys(commands, "visit_id", "patient_id", "hospital_id")
    visit = core["visit"].filter(F.col("visit_status") == "Completed").select(
        "visit_id", F.col("total_amount").alias("claim_amount"), F.lit(True).alias("has_visit")
    )
    claimed = core["claim"].select("visit_id", F.lit(True).alias("has_claim"))
    patient = core["patient"].select("patient_id", F.lit(True).alias("has_patient"))
    hospital = core["hospital"].select("hospital_id", F.lit(True).alias("has_hospital"))
    done = F.col("has_visit").isNotNull()
    decided = (
        commands.join(visit, "visit_id", "left").join(claimed, "visit_id", "left")
        .join(patient, "patient_id", "left").join(hospital, "hospital_id", "left")
        .withColumn("reasons", reason_list(
            (~done, "visit:not_completed"),
            (F.col("has_claim").isNotNull(), "claim:exists"),
            (done & F.col("claim_amount").isNull(), "null:claim_amount"),
            (F.col("claim_amount") < 0, "range:claim_amount"),
            (F.col("has_patient").isNull(), "fk:patient"),
            (F.col("has_hospital").isNull(), "fk:hospital"),
        ))
        .select("seq", "visit_id", "patient_id", "hospital_id", "claim_amount", "reasons")
    )
    decided = first_wins(written(decided, "submit-checks"), "visit_id", "claim:exists")
    accepted, rejected = split(decided, "submit-decisions")
    accepted = next_keys(accepted, ["seq"], core, "claim", 8)
    claims = accepted.select(
        "claim_id", "patient_id", "visit_id", "hospital_id", F.lit(as_of).alias("claim_date"), "claim_amount",
        F.lit(None).cast("decimal(10,2)").alias("approved_amount"), F.lit("Pending Review").alias("claim_status"),
    )
    billed = core["visit_procedure"].select("visit_procedure_id", "visit_id", "procedure_code", "procedure_amount")
    items = accepted.select("seq", "claim_id", "visit_id").join(billed, "visit_id")
    items = next_keys(items, ["seq", "visit_procedure_id"], core, "claim_item", 9).select(
        "claim_item_id", "claim_id", "procedure_code", F.lit(None).cast("string").alias("drug_id"),
        F.col("procedure_amount").alias("item_amount"), F.lit(1).alias("quantity"),
    )
    decisions = accepted.select("seq", "claim_id", "claim_amount", "reasons").unionByName(
        rejected.select(
            "seq", F.lit(None).cast("string").alias("claim_id"),
            F.lit(None).cast("decimal(10,2)").alias("claim_amount"), "reasons",
        )
    )
    return Outcome(decisions, added={"claim": claims, "claim_item": items})


def review_claims(core: Core, commands: DataFrame, as_of: date) -> Outcome:
    """Approve, partly approve or reject claims; a claim is reviewed once."""
    commands = folded_keys(commands, "claim_id").withColumn("new_status", spelled("new_status", CLAIM_STATES))
    claim = core["claim"].select("claim_id", "claim_amount", F.lit(True).alias("has_claim"))
    reviewed = core["claim_approval"].select("claim_id", F.lit(True).alias("has_review"))
    valid = F.coalesce(F.col("new_status").isin(*REVIEW_STATES), F.lit(False))
    decided = (
        commands.join(claim, "claim_id", "left").join(reviewed, "claim_id", "left")
        .withColumn("reasons", reason_list(
            (F.col("has_claim").isNull(), "claim:not_found"),
            (~valid, "status:invalid"),
            ((F.col("new_status") == "Rejected") & F.col("rejection_reason").isNull(), "reason:required"),
            (F.col("reviewed_by").isNull(), "null:reviewed_by"),
            (F.col("has_review").isNotNull(), "unique:claim_id"),
        ))
        .drop("has_claim", "has_review")
    )
    decided = first_wins(written(decided, "review-checks"), "claim_id", "unique:claim_id")
    accepted, rejected = split(decided, "review-decisions")
    accepted = next_keys(accepted, ["seq"], core, "claim_approval", 8)
    approvals = accepted.select(
        "approval_id", "claim_id", "reviewed_by", F.col("new_status").alias("approval_status"),
        F.lit(as_of).alias("approval_date"), "rejection_reason",
    )
    amount = (
        F.when(F.col("new_status") == "Approved", F.col("claim_amount"))
        .when(F.col("new_status") == "Partially Approved", F.col("approved_amount"))
        .otherwise(F.lit(0))
        .cast("decimal(10,2)")
    )
    changes = accepted.select("claim_id", "new_status", amount.alias("new_amount"))
    claims = core["claim"].join(changes, "claim_id").select(
        "claim_id", "patient_id", "visit_id", "hospital_id", "claim_date", "claim_amount",
        F.col("new_amount").alias("approved_amount"), F.col("new_status").alias("claim_status"),
    )
    decisions = accepted.select("seq", "approval_id", "reasons").unionByName(
        rejected.select("seq", F.lit(None).cast("string").alias("approval_id"), "reasons")
    )
    return Outcome(decisions, added={"claim_approval": approvals}, changed={"claim": claims})
