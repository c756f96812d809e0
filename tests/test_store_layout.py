"""What lies in the store's files after writes: untouched months, narrow row groups, numbers, finished batches."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_load_rules import GOOD

from carelake.core import Core
from carelake.operators import audits, commands, hospitals, patients
from carelake.operators.load import load_all
from carelake.sources.store import CoreStore

DAY, NOW = date(2025, 3, 1), datetime(2025, 3, 1, 8)
REVIEW = "seq bigint, claim_id string, reviewed_by string, new_status string, approved_amount decimal(10,2), rejection_reason string"
DISPENSE = "seq bigint, hospital_id string, drug_id string, quantity int, performed_by string"


@pytest.fixture()
def store(spark, tmp_path):
    return CoreStore(spark, str(tmp_path / "core"))


def files_of(store, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.root).rglob("*.parquet") if f"/{name}/" in str(p)}


def test_a_review_rewrites_the_months_of_its_claims_only(spark, store, core_of):
    claims = [{**GOOD["claim"], "claim_id": f"CLM{i:08d}", "visit_id": f"VIS{i}", "claim_date": f"2025-0{1 + i % 3}-10"} for i in range(9)]
    store.append("claim", core_of({"claim": claims})["claim"])
    before = files_of(store, "claim")
    asked = spark.createDataFrame([(1, "CLM00000001", "R", "Rejected", None, "late"), (2, "CLM00000004", "R", "Approved", None, None)], REVIEW)
    commands.review_claims(store.core(), asked, DAY).apply(store)
    after = files_of(store, "claim")
    kept = {p for p in before if "ym=2025-02" not in p}
    assert kept and all(after[p] == before[p] for p in kept)
    assert {p for p in after if "ym=2025-02" not in p} == kept
    assert not {p for p in after if "ym=2025-02" in p} & set(before)
    got = {r.claim_id: r.claim_status for r in store.read("claim").collect()}
    assert len(got) == 9 and got["CLM00000001"] == "Rejected" and got["CLM00000004"] == "Approved"
    assert store.read("claim_approval").count() == 2


def test_approvals_without_a_date_are_stored_and_updated_together(store, core_of):
    rows = [{**GOOD["claim_approval"], "approval_id": f"APR{i:08d}", "claim_id": f"C{i}", "approval_date": d}
            for i, d in enumerate(["2025-01-05", "2025-02-05", None, None])]
    made = core_of({"claim_approval": rows})["claim_approval"]
    store.append("claim_approval", made)
    store.update("claim_approval", made.filter("approval_id = 'APR00000002'").withColumn("reviewed_by", F.lit("again")))
    got = {r.approval_id: (r.reviewed_by == "again", r.ym) for r in store.read("claim_approval").collect()}
    assert got == {"APR00000000": (False, "2025-01"), "APR00000001": (False, "2025-02"), "APR00000002": (True, None), "APR00000003": (False, None)}


def test_a_batch_that_broke_off_is_not_booked_twice(spark, store, core_of, monkeypatch):
    for name in ("drug_inventory", "drug_transaction"):
        store.append(name, core_of({name: [GOOD[name]]})[name])
    asked = spark.createDataFrame([(1, "H001", "DR001", 3, "n"), (2, "H001", "DR001", 1, "n")], DISPENSE)

    def stopped(self, name, rows):
        raise ConnectionError("lost between the two writes")

    with monkeypatch.context() as broken:
        broken.setattr(CoreStore, "update", stopped)
        with pytest.raises(ConnectionError):
            commands.dispense(store.core(), asked, DAY).apply(store, batch="b1")
    stock = core_of({"drug_inventory": [GOOD["drug_inventory"]]})["drug_inventory"].first().quantity_available
    assert store.read("drug_transaction").count() == 3 and store.read("drug_inventory").first().quantity_available == stock
    # Decided anew, the batch would book under other ids and from other stock; what was decided first counts.
    commands.dispense(store.core(), asked, DAY).apply(store, batch="b1")
    for _ in range(2):
        commands.resume(store, "b1")
        assert sorted(r.transaction_id for r in store.read("drug_transaction").collect() if r.transaction_id.startswith("DT")) == ["DT0000001", "DT0000002"]
        assert store.read("drug_inventory").first().quantity_available == stock - 4
    with pytest.raises(LookupError):
        commands.resume(store, "b2")


def test_the_next_number_is_kept_not_sought(spark, store, core_of):
    rows = [{**GOOD["claim"], "claim_id": f"CLM{i:08d}", "visit_id": f"VIS{i}"} for i in (3, 700, 41)]
    store.append("claim", core_of({"claim": [*rows, {**GOOD["claim"], "claim_id": "C9", "visit_id": "V9"}]})["claim"])
    assert store.largest("claim") == store.core().largest("claim") == 700
    store.append("claim", core_of({"claim": [{**GOOD["claim"], "claim_id": "CLM00000800", "visit_id": "VIS8"}]})["claim"])
    assert store.largest("claim") == 800
    store.replace("claim", store.read("claim").filter("claim_id <> 'CLM00000800'"))
    assert store.largest("claim") == 800  # a number is given out once

    unread_rows = store.read("claim").withColumn("claim_id", F.expr("CAST(raise_error('looked through') AS STRING)"))
    core = Core(spark, {"claim": unread_rows}, store.largest)
    placed = commands.next_keys(spark.createDataFrame([(2,), (1,)], "seq long"), ["seq"], core, "claim", 8)
    assert {r.seq: r.claim_id for r in placed.collect()} == {1: "CLM00000801", 2: "CLM00000802"}
    assert core.replaced(claim=store.read("claim")).largest("claim") is None


def test_an_append_that_broke_off_is_found(store, core_of, monkeypatch):
    one = core_of({"claim": [{**GOOD["claim"], "claim_id": "CLM00000005"}]})["claim"]
    with monkeypatch.context() as broken:
        broken.setattr(CoreStore, "_keep_largest", lambda self, name, n: n and (_ for _ in ()).throw(ConnectionError()))
        with pytest.raises(ConnectionError):
            store.append("claim", one)
    assert store.largest("claim") == 5


def scanned_rows(df) -> int:
    """Rows that came out of the Parquet scans of an executed query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan).collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total


def test_one_patient_is_read_from_few_row_groups(spark, store, core_of):
    visit = core_of({"visit": [GOOD["visit"]]})["visit"]
    many = spark.range(60_000).select(F.format_string("PAT%09d", F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("p"), F.col("id"))
    rows = many.crossJoin(visit.drop("patient_id", "visit_id")).withColumns(
        {"patient_id": F.col("p"), "visit_id": F.format_string("VIS%08d", "id")}
    )
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 << 10))
    hadoop.set("parquet.block.size.row.check.min", "100")
    try:
        store.append("visit", rows)
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.block.size.row.check.min")
    groups = met = 0
    for path in files_of(store, "visit"):
        data = pq.ParquetFile(path).metadata
        column = data.schema.names.index("patient_id")
        for g in range(data.num_row_groups):
            bounds = data.row_group(g).column(column).statistics
            groups += 1
            met += bounds.min <= "PAT000007777" <= bounds.max
    assert groups >= 8 and met <= max(2, len(files_of(store, "visit")) * 2) and met < groups / 2
    wanted = patients.visits_of(store.core(), "PAT000007777").select("visit_id", "patient_id")
    assert scanned_rows(wanted) < 60_000 / 2
    assert wanted.count() == rows.filter("patient_id = 'PAT000007777'").count() > 0


def test_a_key_inside_the_range_is_ruled_out_by_the_bloom_filter(spark, store, core_of):
    person = core_of({"patient": [GOOD["patient"]]})["patient"]
    rows = spark.range(20_000).crossJoin(person.drop("patient_id", "national_id")).selectExpr(
        "*", "concat('PAT', id) AS patient_id", "CAST(2 * id AS decimal(18,0)) AS national_id"
    )
    store.append("patient", rows)
    odd = patients.patient_by_national_id(store.core(), 15_001, DAY)
    even = patients.patient_by_national_id(store.core(), 15_000, DAY)
    assert scanned_rows(odd) == 0 < scanned_rows(even)
    assert (odd.count(), even.count()) == (0, 1)


def test_old_snapshots_are_read_for_the_missing_hospitals_only(spark, store, core_of, monkeypatch):
    rows = [{"icu_status_id": f"I{h}{m}{d}", "hospital_id": f"H00{h}", "occupied_beds": m + d, "available_beds": h, "update_time": f"2025-0{m}-0{d} 08:00:00"}
            for h in (1, 2, 3) for m in (1, 2, 3, 4) for d in (1, 2) if not (h == 3 and m > 3)]
    core = core_of({"icu_status": rows, "hospital": [{**GOOD["hospital"], "hospital_id": f"H00{h}"} for h in (1, 2, 3)]})
    for name in ("icu_status", "hospital"):
        store.append(name, core[name])
    looked, whole = [], hospitals.written
    monkeypatch.setattr(hospitals, "written", lambda df, label: looked.append(label) or whole(df, label))
    got = hospitals.latest_icu(store.core())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, hospitals.newest_of(core["icu_status"]).collect()))
    assert [x for x in looked if x.startswith("icu-")] == ["icu-2025-04", "icu-2025-03"]
    lonely = Core(spark, {"icu_status": store.read("icu_status"), "hospital": core["hospital"].limit(0)})
    assert hospitals.latest_icu(lonely).count() == 0


def test_side_by_side_and_counted_while_written(store, staged, monkeypatch):
    staging = {name: staged(name, [row]) for name, row in GOOD.items()}
    staging["hospital"] = staged("hospital", [GOOD["hospital"], {**GOOD["hospital"], "hospital_id": "H002", "district": "x"}])
    staging["bed"] = staged("bed", [GOOD["bed"], GOOD["bed"]])
    for _ in range(2):
        load_all(staging, store, NOW)
    core, log = store.core(), store.load_log()
    counted = {(r.schema_name, r.table_name): r.row_count for r in audits.row_counts(core).collect()}
    assert {(r.schema_name, r.table_name): r.row_count for r in audits.loaded_rows(log).collect()} == counted
    want = {r.stg_table: r.pending for r in audits.pending(staging, core).collect()}
    assert {r.stg_table: r.pending for r in audits.last_pending(log).collect()} == want and want["stg.bed"] == 2
    assert sorted(map(tuple, audits.load_errors(log).collect())) == sorted(map(tuple, audits.errors(store.error_log()).collect()))
    again = {r.target_table: (r.staged, r.accepted, r.known) for r in log.orderBy("accepted").collect()}
    assert again["clin.visit"] == (1, 1, 0) and log.filter("target_table = 'clin.visit' AND known = 1").count() == 1


def test_a_table_that_raises_does_not_stop_others(store, staged, spark):
    broken = staged("bed", [GOOD["bed"]]).withColumn("bed_number", F.expr("raise_error('no bed')"))
    staging = {"hospital": staged("hospital", [GOOD["hospital"]]), "department": staged("department", [GOOD["department"]]), "bed": broken,
               "patient": staged("patient", [GOOD["patient"]])}
    load_all(staging, store, NOW)
    assert {n: store.read(n).count() for n in staging} == {"hospital": 1, "department": 1, "bed": 0, "patient": 1}
    assert [r.target_table for r in store.error_log().collect()] == ["hosp.bed"]
    assert {r.target_table: r.staged for r in store.load_log().collect()} == {"hosp.hospital": 1, "hosp.department": 1, "hosp.bed": None, "pat.patient": 1}
