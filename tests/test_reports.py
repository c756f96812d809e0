"""Report properties on small hand-made tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.operators import fraud, hospitals, patients, pharmacy, views
from carelake.sources.driver_tables import AS_OF, driver_core
from conftest import SF
from test_load_rules import GOOD

DAY = date(2025, 3, 1)


@pytest.fixture(scope="module")
def core(core_of):
    tables = {name: [row] for name, row in GOOD.items()}
    tables["hospital"] = [GOOD["hospital"], {**GOOD["hospital"], "hospital_id": "H002", "hospital_name": "Two"}]
    return core_of(tables)


def test_hospitals_without_facts_are_kept(core):
    rows = {r.hospital_id: r for r in hospitals.hospital_capacity(core).collect()}
    assert (rows["H002"].total_bed_records, rows["H002"].occupancy_pct, rows["H002"].icu_occupied) == (0, None, None)
    assert rows["H001"].occupancy_pct == Decimal("100.0")
    score = {r.hospital_id: r for r in hospitals.hospital_performance(core).collect()}
    assert (score["H002"].total_claims, score["H002"].rejection_rate_pct, score["H002"].avg_rating) == (0, None, None)


def test_newest_icu_snapshot_wins(core, core_of):
    snapshot = GOOD["icu_status"]
    many = core_of({"icu_status": [
        {**snapshot, "icu_status_id": "I1", "update_time": "2025-01-01 00:00:00", "occupied_beds": 2},
        {**snapshot, "icu_status_id": "I2", "update_time": "2025-01-03 00:00:00", "occupied_beds": 1},
    ]})
    row = hospitals.icu_alerts(core.replaced(icu_status=many["icu_status"]), 50.0).first()
    assert (row.occupied_beds, row.icu_occupancy_pct) == (1, Decimal("50.0"))


def test_today_is_not_expiring_soon(core, core_of):
    stock = GOOD["drug_inventory"]
    dates = ["2025-03-01", "2025-03-02", "2025-04-30", "2025-05-01", None]
    rows = [{**stock, "inventory_id": f"V{i}", "expiration_date": d} for i, d in enumerate(dates)]
    with_stock = core.replaced(drug_inventory=core_of({"drug_inventory": rows})["drug_inventory"])
    found = pharmacy.expiring_soon(with_stock, DAY, 60).collect()
    assert sorted(r.days_to_expiry for r in found) == [1, 60]
    near = views.inventory_alert(with_stock, DAY).filter("expiry_status = 'Near Expiry'").count()
    assert near == 3  # already expired and today count as near, unknown does not


def test_missing_patient_raises(core):
    assert patients.find_patient(core, "29001019876543", DAY).first().age == 42
    with pytest.raises(LookupError):
        patients.find_patient(core, 1, DAY)


def test_month_without_visits_is_not_filled(core, core_of):
    visit = GOOD["visit"]
    rows = [{**visit, "visit_id": f"V{i}", "visit_date": d} for i, d in enumerate(["2025-01-05", "2025-01-06", "2025-04-01"])]
    months = hospitals.monthly_visits(core.replaced(visit=core_of({"visit": rows})["visit"])).orderBy("month").collect()
    assert [(r.month, r.prev_month_visits, r.mom_change_pct) for r in months] == [
        ("2025-01", None, None), ("2025-04", 2, Decimal("-50.0")),
    ]


def test_duplicate_claims_have_one_shape_at_every_size(spark, core):
    claims = spark.createDataFrame(
        [(f"C{i:04d}", "PAT1", "VIS1", Decimal("2.00")) for i in range(1500)] + [("X", "PAT1", "VIS2", Decimal("1.00"))],
        "claim_id string, patient_id string, visit_id string, claim_amount decimal(10,2)",
    )
    rows = fraud.duplicate_claims(core, claims).collect()
    assert [(r.visit_id, r.claim_count, r.total_claimed) for r in rows] == [("VIS1", 1500, Decimal("3000.00"))]
    ids = sorted(r.claim_id for r in fraud.duplicate_claim_ids(claims).collect())
    assert ids == [f"C{i:04d}" for i in range(1500)]


def test_counting_first_equals_joining_first(spark):
    """The score card without the fact-by-fact join has the numbers the joined form has."""
    core = driver_core(spark, SF)
    few = core["hospital"].filter("hospital_no < 5").select("hospital_id")
    small = core.replaced(**{
        "hospital": core["hospital"].join(few, "hospital_id", "left_semi"),
        "claim": core["claim"].filter("claim_no % 7 = 0"),
        "patient_feedback": core["patient_feedback"].join(few, "hospital_id", "left_semi"),
    })
    got = {r.hospital_id: r for r in hospitals.hospital_performance(small).collect()}
    visits = small["visit"].filter("visit_status = 'Completed'").select("hospital_id", "waiting_time")
    naive = (
        small["hospital"].select("hospital_id")
        .join(small["patient_feedback"].select("hospital_id", "feedback_id", "rating"), "hospital_id", "left")
        .join(visits, "hospital_id", "left")
        .join(small["claim"].select("hospital_id", "claim_id"), "hospital_id", "left")
        .groupBy("hospital_id")
        .agg(
            F.avg("rating").cast("decimal(3,1)").alias("avg_rating"),
            F.countDistinct("feedback_id").alias("total_feedback"),
            F.avg("waiting_time").cast("decimal(12,1)").alias("avg_waiting_min"),
            F.countDistinct("claim_id").alias("total_claims"),
        )
    )
    for row in naive.collect():
        for field in ("avg_rating", "total_feedback", "avg_waiting_min", "total_claims"):
            assert got[row.hospital_id][field] == row[field]


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_plans_stay_jvm_side_and_without_products(spark):
    import registry

    core = driver_core(spark, SF)
    for name, report in registry.REPORTS.items():
        plan = plan_of(report(core))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEvalPython"):
            assert word not in plan, (name, word)


def test_unprescribed_drugs_use_an_anti_join(spark):
    plan = plan_of(fraud.dispensed_without_prescription(driver_core(spark, SF), AS_OF))
    assert "LeftAnti" in plan
