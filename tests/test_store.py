from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.functions.figures import months_before, within
from carelake.operators import audits, commands
from carelake.operators.load import load_all
from carelake.sources.store import CoreStore
from test_load_rules import GOOD

DAY = date(2025, 3, 1)
NOW = datetime(2025, 3, 1, 8)


@pytest.fixture()
def store(spark, tmp_path):
    return CoreStore(spark, str(tmp_path / "core"))


@pytest.fixture()
def staging(staged):
    tables = {name: staged(name, [row]) for name, row in GOOD.items()}
    tables["hospital"] = staged("hospital", [GOOD["hospital"], {**GOOD["hospital"], "hospital_id": "H002"}])
    tables["drug"] = staged("drug", [GOOD["drug"], {**GOOD["drug"], "drug_id": "DR002", "unit_amount": "x"}])
    return tables


def only(staging, *names):
    return {name: staging[name] for name in names}


def test_load_all_audits_and_rerun(store, staging):
    staging = only(staging, "diagnosis", "drug", "hospital", "department", "doctor", "patient", "visit")
    load_all(staging, store, NOW)
    counts = {r.table_name: r.row_count for r in audits.row_counts(store.core()).collect() if r.row_count}
    assert counts == {**{name: 1 for name in staging}, "hospital": 2}
    assert [tuple(r) for r in audits.errors(store.error_log()).collect()] == [("ref.drug", 1, NOW, NOW)]
    pending = {r.stg_table: r.pending for r in audits.pending(staging, store.core()).collect()}
    assert pending == {**{f"stg.{name}": 0 for name in staging}, "stg.drug": 1}
    load_all(staging, store, NOW)
    again = {r.table_name: r.row_count for r in audits.row_counts(store.core()).collect() if r.row_count}
    assert again == counts


@pytest.fixture()
def filled(store, core_of):
    """A store that holds one good row of each table the commands and updates use."""
    names = ["hospital", "department", "doctor", "patient", "diagnosis", "drug_inventory", "drug_transaction",
             "visit", "visit_procedure", "claim", "claim_item", "claim_approval"]
    core = core_of({name: [GOOD[name]] for name in names})
    for name in names:
        store.append(name, core[name])
    return store


def test_rejected_parent_rejects_its_children(store, staging, staged):
    staging["hospital"] = staged("hospital", [{**GOOD["hospital"], "district": "Huge"}])
    load_all(only(staging, "hospital", "department", "bed", "drug"), store, NOW)
    core = store.core()
    assert core["hospital"].count() == core["department"].count() == core["bed"].count() == 0
    assert core["drug"].count() == 1


def test_a_failing_table_does_not_stop_the_next(store, staging, staged):
    staging["bed"] = staged("bed", [GOOD["bed"], GOOD["bed"]])
    load_all(only(staging, "hospital", "department", "bed", "patient"), store, NOW)
    assert store.core()["bed"].count() == 0
    assert store.core()["patient"].count() == 1
    reasons = store.error_log().filter("target_table = 'hosp.bed'").collect()
    assert [(r.source_key, r.reasons) for r in reasons] == [(None, ["duplicate:bed_id"])]


def test_replace_makes_a_new_version_and_months_are_pruned(filled):
    store = filled
    visits = store.read("visit")
    later = visits.withColumn("visit_date", F.lit(date(2025, 4, 1))).withColumn("visit_id", F.lit("VIS2"))
    store.append("visit", later)
    assert sorted(r.ym for r in store.read("visit").collect()) == ["2025-02", "2025-04"]
    plan = within(store.read("visit"), "visit_date", date(2025, 4, 1), date(2025, 4, 30))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "2025-04" in plan
    store.replace("visit", store.read("visit").filter("visit_id = 'VIS2'"))
    assert [r.visit_id for r in store.read("visit").collect()] == ["VIS2"]


def test_commands_change_the_store(spark, filled):
    store = filled
    ask = "seq bigint, hospital_id string, drug_id string, quantity int, performed_by string"
    asked = [(1, "h001", "DR001", 3, "n"), (2, "H001", "DR001", 9, "n"), (3, "H001", "DR001", 2, "n"),
             (4, "H001", "DR999", 1, "n"), (5, "H001", "DR001", 0, "n")]
    outcome = commands.dispense(store.core(), spark.createDataFrame(asked, ask), DAY)
    got = {r.seq: (r.transaction_id, r.remaining_stock, r.reasons) for r in outcome.decisions.collect()}
    assert got == {
        1: ("DT0000001", 2, []), 2: (None, None, ["stock:insufficient"]), 3: ("DT0000002", 0, []),
        4: (None, None, ["stock:not_found"]), 5: (None, None, ["check:quantity"]),
    }
    outcome.apply(store)
    assert store.read("drug_inventory").first().quantity_available == 0
    again = commands.dispense(store.core(), spark.createDataFrame([(1, "H001", "DR001", 1, "n")], ask), DAY)
    assert again.decisions.first().reasons == ["stock:insufficient"]

    ask = ("seq bigint, patient_id string, hospital_id string, doctor_id string, department_id string,"
           " diagnosis_code string, visit_type string, symptoms string, waiting_time int, total_amount decimal(10,2)")
    visit = ("PAT1", "H001", "DOC0001", "DEPT0001", "D001", "emergency", "s", 5, Decimal("70.00"))
    rows = [(7, *visit), (3, *visit), (5, "PAT9", *visit[1:])]
    outcome = commands.register_visits(store.core(), spark.createDataFrame(rows, ask), DAY)
    got = {r.seq: (r.visit_id, r.reasons) for r in outcome.decisions.collect()}
    assert got == {3: ("VIS00000002", []), 7: ("VIS00000003", []), 5: (None, ["patient:not_found"])}
    outcome.apply(store)

    ask = "seq bigint, visit_id string, patient_id string, hospital_id string"
    rows = [(1, "VIS1", "PAT1", "H001"), (2, "VIS00000002", "PAT9", "H001"), (3, "vis00000002", "PAT1", "H001"),
            (4, "VIS00000002", "PAT1", "H001"), (5, "NONE", "PAT1", "H001")]
    outcome = commands.submit_claims(store.core(), spark.createDataFrame(rows, ask), DAY)
    got = {r.seq: (r.claim_id, r.reasons) for r in outcome.decisions.collect()}
    assert got == {
        1: (None, ["claim:exists"]), 2: (None, ["fk:patient"]), 3: ("CLM00000001", []),
        4: (None, ["claim:exists"]), 5: (None, ["visit:not_completed"]),
    }
    outcome.apply(store)

    ask = ("seq bigint, claim_id string, reviewed_by string, new_status string, approved_amount decimal(10,2),"
           " rejection_reason string")
    new = "CLM00000001"
    rows = [(1, new, "R", "Rejected", None, None), (2, new, "R", "partially approved", Decimal("30.00"), None),
            (3, new, "R", "Approved", None, None), (4, "C1", "R", "Approved", None, None), (5, new, "R", "Maybe", None, None),
            (6, "C9", None, "Approved", None, None)]
    outcome = commands.review_claims(store.core(), spark.createDataFrame(rows, ask), DAY)
    got = {r.seq: (r.approval_id, r.reasons) for r in outcome.decisions.collect()}
    assert got == {
        1: (None, ["reason:required"]), 2: ("APR00000001", []), 3: (None, ["unique:claim_id"]),
        4: (None, ["unique:claim_id"]), 5: (None, ["status:invalid"]),
        6: (None, ["claim:not_found", "null:reviewed_by"]),
    }
    outcome.apply(store)
    claim = store.read("claim").filter(F.col("claim_id") == new).first()
    assert (claim.claim_status, int(claim.approved_amount)) == ("Partially Approved", 30)
    assert store.read("claim_approval").count() == 2


def test_months_before_ends_on_the_last_day():
    assert months_before(date(2025, 3, 31), 1) == date(2025, 2, 28)
    assert months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert months_before(date(2025, 7, 31), 1) == date(2025, 6, 30)
    assert months_before(date(2025, 1, 15), 3) == date(2024, 10, 15)
