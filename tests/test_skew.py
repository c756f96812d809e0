"""One key holds a third of the rows: results stay whole and no task gets the whole key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from carelake.operators import fraud, hospitals, patients, views
from carelake.operators.load import validated_load
from carelake.schemas import BY_NAME
from carelake.sources.driver_tables import AS_OF, driver_core
from conftest import SF

# As on a cluster with large tables: nothing small enough to broadcast, small split targets.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@pytest.fixture()
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot(spark):
    """Every third visit belongs to one patient, one doctor and one hospital."""
    core = driver_core(spark, SF)
    third = F.col("order_no") % 3 == 0
    fixed = {"patient_id": "PAT000007", "doctor_id": "DOC0001", "hospital_id": "H016"}
    visits = core["visit"].withColumns({c: F.when(third, F.lit(v)).otherwise(F.col(c)) for c, v in fixed.items()})
    return core.replaced(visit=visits)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_dominant_patient_is_split(spark, hot, large):
    many = hot["visit"].withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30))))
    many = many.withColumn("visit_id", F.concat("visit_id", F.lit("-"), F.col("copy").cast("string"))).drop("copy")
    detail = views.visit_detail(hot.replaced(visit=many))
    rows = detail.collect()
    assert len(rows) == hot["visit"].count() * 30
    assert "skew=true" in final_plan(detail)


def test_counts_of_a_dominant_patient_and_doctor(hot, large):
    visits = hot["visit"].collect()
    done = [v for v in visits if v.visit_status == "Completed"]
    months = hospitals.monthly_visits(hot).agg(F.sum("total_visits")).first()[0]
    assert months == len(done)
    severe = {r.diagnosis_code for r in hot["diagnosis"].collect() if r.severity_level == "Severe"}
    risky = {r.patient_id: r.total_visits for r in patients.high_risk_patients(hot, AS_OF).collect()}
    assert risky["PAT000007"] == sum(v.patient_id == "PAT000007" and v.diagnosis_code in severe for v in done)
    summary = {r.doctor_id: r for r in fraud.fraud_summary_by_doctor(hot).collect()}
    refused = {a.claim_id for a in hot["claim_approval"].collect() if a.approval_status == "Rejected"}
    doctor_of = {v.visit_id: v.doctor_id for v in visits}
    claims = [c for c in hot["claim"].collect() if c.claim_id in refused]
    assert summary["DOC0001"].rejected_claims_count == sum(doctor_of[c.visit_id] == "DOC0001" for c in claims)


def test_load_with_a_dominant_missing_parent(spark, large):
    """Most rows name one parent, which does not exist: all are quarantined, the rest load."""
    core = driver_core(spark, SF)
    table = BY_NAME["prescription"]
    rows = core["prescription"].select(*[F.col(c).cast("string").alias(c) for c in table.column_names])
    lost = F.col("visit_id").substr(11, 1) < "7"
    rows = rows.withColumn("visit_id", F.when(lost, F.lit("NONE")).otherwise(F.col("visit_id")))
    result = validated_load(rows, table, core.replaced(prescription=core["prescription"].limit(0)), check_widths=False)
    bad = rows.filter("visit_id = 'NONE'").count()
    assert result.quarantined.count() == bad > 0
    assert result.accepted.count() == rows.count() - bad
    assert {tuple(r.reasons) for r in result.quarantined.collect()} == {("fk:visit",)}
