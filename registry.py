"""Every query by name: the Spark callable and, where SQL can say it, the DuckDB text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.operators import audits, claims, commands, fraud, hospitals, patients, pharmacy, views
from carelake.operators.dispensing import FOLD_LIMIT
from carelake.operators.load import load_all, load_files, validated_load
from carelake.plans.session import discard, free_shuffles, scratch_folder, stored_bytes, written
from carelake.schemas import BY_NAME, TABLES, Table
from carelake.sources.command_batches import batch, dispense_commands
from carelake.sources.driver_tables import AS_OF, BY_ORDER, ORDER_KEYS, driver_core
from carelake.sources.staging import partly_loaded, staged_table
from carelake.sources.store import CoreStore
from carelake.sources.text_files import read_csv, read_delimited, read_tsv, readable, write_delimited
from oracle import commands as command_sql
from oracle import loads, reports

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TIME = datetime(1998, 6, 1, 12, 0, 0)
INGESTED_TOGETHER = 4  # tables whose shuffles and files lie on disk at a time
SLICE_BYTES = 1 << 30


# The driver's ids are longer than the core's columns, so most loads leave the length rules out; these apply them.
WITH_WIDTHS = ("doctor", "drug")


def run_load(core: Core, name: str, check_widths: bool = False):
    """One table's load onto a core that already holds part of it."""
    before = core.replaced(**{name: partly_loaded(core, name)})
    return validated_load(staged_table(core, name), BY_NAME[name], before, check_widths=check_widths)


def load_query(name: str) -> Query:
    return lambda spark, sf_dir: run_load(driver_core(spark, sf_dir), name).accepted


def quarantine_query(name: str, check_widths: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = run_load(driver_core(spark, sf_dir), name, check_widths).quarantined
        return rows.withColumn("reasons", F.array_join("reasons", ","))

    return run


_loads: dict[tuple[str, str], str] = {}


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load of all staged tables into an empty store logged; the queries of one application share that load."""
    loaded = (spark.sparkContext.applicationId, sf_dir)
    if loaded not in _loads:
        core = driver_core(spark, sf_dir)
        store = CoreStore(spark, f"{scratch_folder(spark)}/core-{uuid.uuid4().hex}")
        load_all({t.name: staged_table(core, t.name) for t in TABLES}, store, LOAD_TIME, check_widths=False)
        _loads[loaded] = store.root
    return CoreStore(spark, _loads[loaded]).load_log()


def delivered(core: Core, name: str, sep: str, quoted: bool) -> str:
    """The staged rows of a table written out as text files; returns their folder."""
    path = f"{scratch_folder(core.spark)}/files-{name}-{uuid.uuid4().hex}"
    write_delimited(staged_table(core, name), path, sep, quoted, "lz4")
    return path


def ingest_csv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table delivered as CSV and read back: rows and characters per staging table.

    What is written of a table is counted at once and then deleted, and a table whose rows belong to one order each is delivered in slices of
    the orders, one for about ``SLICE_BYTES`` of them and their lines. So neither the files nor the shuffles of a whole large table lie on disk.
    """
    slices = 1 + sum(stored_bytes(spark, f"{sf_dir}/{name}.parquet") for name in ORDER_KEYS) // SLICE_BYTES

    def counted(table: Table) -> tuple[str, int, int | None]:
        rows, characters = 0, None
        mine = slices if table.name in BY_ORDER else 1
        for i in range(mine):
            core = driver_core(spark, sf_dir, (i, mine))
            path = delivered(core, table.name, ",", True)
            free_shuffles(spark)
            staged = readable(read_csv(spark, path, table, LOAD_TIME))
            width = sum((F.coalesce(F.length(c), F.lit(0)) for c in table.column_names), F.lit(0))
            found = staged.agg(F.count(F.lit(1)).alias("row_count"), F.sum(width).alias("characters")).first()
            discard(spark, path)
            rows += found.row_count
            if found.row_count:
                characters = (characters or 0) + found.characters
        return f"stg.{table.name}", rows, characters

    with ThreadPoolExecutor(INGESTED_TOGETHER) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(counted), table) for table in TABLES]
        found = [part.result() for part in started]
    return spark.createDataFrame(found, "stg_table string, row_count bigint, characters bigint")


def ingest_tsv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    core, table = driver_core(spark, sf_dir), BY_NAME["patient"]
    staged = readable(read_tsv(spark, delivered(core, "patient", "\t", False), table, LOAD_TIME))
    return staged.select(*table.column_names)


def load_from_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivered CSV file straight into a core table that already holds part of it, with the length rules on."""
    core = driver_core(spark, sf_dir)
    before = core.replaced(doctor=partly_loaded(core, "doctor"))
    return load_files(spark, delivered(core, "doctor", ",", True), BY_NAME["doctor"], before, LOAD_TIME).accepted


def load_all_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table delivered as CSV and loaded straight into an empty core, parents first: staged, accepted and quarantined rows.

    The patients come as tab-separated text.
    """
    core = driver_core(spark, sf_dir)
    store = CoreStore(spark, f"{scratch_folder(spark)}/core-{uuid.uuid4().hex}")
    folders: dict[str, str] = {}

    def staged(table: Table) -> DataFrame:
        sep, quoted = ("\t", False) if table.name == "patient" else (",", True)
        folders[table.name] = delivered(core, table.name, sep, quoted)
        rows = read_delimited(spark, folders[table.name], table, LOAD_TIME, sep, quoted)
        return readable(rows).select(*table.column_names)

    load_all(
        {table.name: partial(staged, table) for table in TABLES}, store, LOAD_TIME, check_widths=False,
        done=lambda name: discard(spark, folders[name]),
    )
    return audits.load_summary(store.load_log())


def load_repeated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that holds every row twice: the first of each key is accepted."""
    core = driver_core(spark, sf_dir)
    before = core.replaced(department=partly_loaded(core, "department"))
    staged = staged_table(core, "department")
    table = BY_NAME["department"]
    return validated_load(staged.union(staged), table, before, on_duplicate="first", check_widths=False).accepted


def load_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.load_summary(load_log(spark, sf_dir))


def row_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.loaded_rows(load_log(spark, sf_dir))


def errors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.load_errors(load_log(spark, sf_dir))


def pending_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.last_pending(load_log(spark, sf_dir))


# Reports over the clean domain tables, with the fixed driver parameters.
REPORTS: dict[str, Callable[[Core], DataFrame]] = {
    "vw_visit_detail": views.visit_detail,
    "vw_inventory_alert": lambda core: views.inventory_alert(core, AS_OF),
    "vw_claim_summary": views.claim_summary,
    "vw_icu_occupancy_rate": views.icu_occupancy_rate,
    "patient_by_national_id": lambda core: patients.patient_by_national_id(core, 28000000000006, AS_OF),
    "patient_visit_history": lambda core: patients.patient_visit_history(core, "PAT000007"),
    "patient_prescription_history": lambda core: patients.patient_prescription_history(core, "PAT000007"),
    "high_risk_patients": lambda core: patients.high_risk_patients(core, AS_OF),
    "hospital_capacity": hospitals.hospital_capacity,
    "icu_alerts": hospitals.icu_alerts,
    "doctor_workload": lambda core: hospitals.doctor_workload(core, AS_OF),
    "doctor_workload_h016": lambda core: hospitals.doctor_workload(core, AS_OF, "H016"),
    "referral_summary": lambda core: hospitals.referral_summary(core, AS_OF),
    "low_stock": pharmacy.low_stock,
    "low_stock_h016": lambda core: pharmacy.low_stock(core, "H016"),
    "expiring_soon": lambda core: pharmacy.expiring_soon(core, AS_OF),
    "expiring_soon_h016": lambda core: pharmacy.expiring_soon(core, AS_OF, hospital_id="H016"),
    "drug_consumption": lambda core: pharmacy.drug_consumption(core, AS_OF),
    "drug_consumption_h016": lambda core: pharmacy.drug_consumption(core, AS_OF, "H016"),
    "claims_by_status": lambda core: claims.claims_by_status(core, AS_OF),
    "claims_by_status_rejected": lambda core: claims.claims_by_status(core, AS_OF, "rejected"),
    "claims_by_status_h016": lambda core: claims.claims_by_status(core, AS_OF, hospital_id="h016"),
    "rejection_reasons": lambda core: claims.rejection_reasons(core, AS_OF),
    "inflated_procedures": fraud.inflated_procedures,
    "dispensed_without_rx": lambda core: fraud.dispensed_without_prescription(core, AS_OF),
    "duplicate_claims": lambda core: fraud.duplicate_claims(core, core["stg_claim_dup"]),
    "duplicate_claim_ids": lambda core: fraud.duplicate_claim_ids(core["stg_claim_dup"]),
    "abnormal_rx_quantity": fraud.abnormal_rx_quantity,
    "fraud_summary_by_doctor": fraud.fraud_summary_by_doctor,
    "monthly_visits": hospitals.monthly_visits,
    "monthly_visits_h016": lambda core: hospitals.monthly_visits(core, "H016"),
    "hospital_performance": hospitals.hospital_performance,
    "top_diagnoses": hospitals.top_diagnoses,
    "top_diagnoses_h016": lambda core: hospitals.top_diagnoses(core, hospital_id="H016"),
}


def register(core: Core) -> commands.Outcome:
    return commands.register_visits(core, batch(core, "register_commands"), AS_OF)


def dispense(core: Core, fold_limit: int = FOLD_LIMIT) -> commands.Outcome:
    return commands.dispense(core, dispense_commands(core), AS_OF, fold_limit)


def dispensed_inventory(core: Core) -> DataFrame:
    """The inventory after dispensing. A store holds it; here it is a sum over all lines, which is taken once for all uses."""
    core = core.replaced(drug_inventory=written(core["drug_inventory"], "inventory", "zstd"))
    return commands.updated(core, dispense(core), "drug_inventory")


def submit(core: Core) -> commands.Outcome:
    return commands.submit_claims(core, batch(core, "submit_commands"), AS_OF)


def review(core: Core) -> commands.Outcome:
    core = core.replaced(claim_approval=batch(core, "reviews_so_far"))
    return commands.review_claims(core, batch(core, "review_commands"), AS_OF)


def decisions(outcome: commands.Outcome) -> DataFrame:
    return outcome.decisions.withColumn("reasons", F.array_join("reasons", ","))


COMMANDS: dict[str, Callable[[Core], DataFrame]] = {
    "cmd_register_visits": lambda core: decisions(register(core)),
    "cmd_dispense": lambda core: decisions(dispense(core)),
    # The way of crowded keys, for every key with more than two commands.
    "cmd_dispense_hot": lambda core: decisions(dispense(core, fold_limit=2)),
    "cmd_dispense_inventory": dispensed_inventory,
    "cmd_submit_claims": lambda core: decisions(submit(core)),
    "cmd_submit_claim_items": lambda core: submit(core).added["claim_item"],
    "cmd_review_decisions": lambda core: decisions(review(core)),
    "cmd_review_claims": lambda core: commands.updated(core, review(core), "claim").select(
        "claim_id", "claim_status", "approved_amount"
    ),
    "cmd_review_approvals": lambda core: review(core).added["claim_approval"],
}


def report_query(name: str) -> Query:
    return lambda spark, sf_dir: {**REPORTS, **COMMANDS}[name](driver_core(spark, sf_dir))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: report_query(name) for name in (*REPORTS, *COMMANDS)}
    found.update({f"load_{t.name}": load_query(t.name) for t in TABLES})
    found.update({f"quarantine_{t.name}": quarantine_query(t.name) for t in TABLES})
    found.update({f"quarantine_{name}_widths": quarantine_query(name, True) for name in WITH_WIDTHS})
    found["load_from_files"] = load_from_files_query
    found["load_repeated"] = load_repeated_query
    found["ingest_csv"] = ingest_csv_query
    found["ingest_tsv"] = ingest_tsv_query
    found["load_all"] = load_all_query
    found["load_all_files"] = load_all_files_query
    found["audit_row_counts"] = row_counts_query
    found["audit_errors"] = errors_query
    found["audit_pending"] = pending_query
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {**reports.sql(), **command_sql.sql()}
    found.update({f"load_{t.name}": loads.accepted_sql(t.name) for t in TABLES})
    found.update({f"quarantine_{t.name}": loads.quarantine_sql(t.name) for t in TABLES})
    found.update({f"quarantine_{name}_widths": loads.quarantine_sql(name, True) for name in WITH_WIDTHS})
    found["load_from_files"] = loads.accepted_sql("doctor", True)
    found["load_repeated"] = loads.accepted_sql("department")
    found["ingest_csv"] = loads.ingest_csv_sql()
    found["ingest_tsv"] = loads.staged_sql("patient")
    found["load_all"] = found["load_all_files"] = loads.load_all_sql()
    found["audit_row_counts"] = loads.row_counts_sql()
    found["audit_errors"] = loads.errors_sql(str(LOAD_TIME))
    found["audit_pending"] = loads.pending_sql()
    return found
