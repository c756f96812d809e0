"""Fraud signals: inflated prices, unprescribed drugs, duplicate claims, odd quantities.

Each detector applies its test to the narrowest rows that allow it, before names are joined.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import months_before, percent, rounded, within
from carelake.functions.text import person

# Doses a day for each prescribed frequency; any other counts as one.
DOSES_PER_DAY = {
    "Once daily": 1, "Twice daily": 2, "Three times daily": 3,
    "Every 12 hours": 2, "Every 8 hours": 3, "Every 6 hours": 4,
}
INFLATION_LIMIT = 20.0
QUANTITY_LIMIT = 1.8


def decimal(value: float) -> Column:
    return F.lit(Decimal(str(value)))


def inflated(core: Core, threshold: float = INFLATION_LIMIT) -> DataFrame:
    """Performed procedures charged ``threshold`` percent or more above the catalogue."""
    catalogue = core["medical_procedure"].select("procedure_code", "procedure_name", "expected_amount")
    over = percent(F.col("procedure_amount") - F.col("expected_amount"), F.col("expected_amount"))
    return (
        core["visit_procedure"].join(catalogue, "procedure_code")
        .withColumn("inflation", over)
        .filter(F.col("inflation") >= decimal(threshold))
    )


def inflated_procedures(core: Core, threshold: float = INFLATION_LIMIT) -> DataFrame:
    visit = core["visit"].select("visit_id", "visit_date", "hospital_id", "doctor_id", "patient_id")
    patient = core["patient"].select("patient_id", person("first_name", "last_name").alias("patient_name"))
    doctor = core["doctor"].select("doctor_id", person("first_name", "last_name").alias("doctor_name"))
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return (
        inflated(core, threshold)
        .join(visit, "visit_id").join(patient, "patient_id").join(doctor, "doctor_id").join(hospital, "hospital_id")
        .select(
            "visit_procedure_id", "visit_id", "visit_date", "hospital_name", "doctor_name", "procedure_name",
            "expected_amount", F.col("procedure_amount").alias("actual_cost"),
            rounded(F.col("inflation")).alias("inflation_pct"), "patient_name",
            F.lit("Inflated Procedure Cost").alias("fraud_signal"),
        )
    )


def dispensed_without_prescription(
    core: Core, as_of: date, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Dispensed drugs with no prescription for that drug, hospital and day (default: three months).

    A prescription can only match on its own day, so prescriptions outside the period are
    left out before they are joined to their items.
    """
    start, end = start or months_before(as_of, 3), end or as_of
    moves = within(core["drug_transaction"], "transaction_date", start, end).filter(
        F.col("transaction_type") == "Dispensing"
    )
    scripts = within(core["prescription"], "prescription_date", start, end).select(
        "prescription_id", "visit_id", F.col("prescription_date").alias("transaction_date")
    )
    prescribed = (
        scripts.join(core["visit"].select("visit_id", "hospital_id"), "visit_id")
        .join(core["prescription_item"].select("prescription_id", "drug_id"), "prescription_id")
        .select("drug_id", "hospital_id", "transaction_date")
        .distinct()
    )
    drug = core["drug"].select("drug_id", "drug_name", "drug_category")
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return (
        moves.join(prescribed, ["drug_id", "hospital_id", "transaction_date"], "left_anti")
        .join(drug, "drug_id").join(hospital, "hospital_id")
        .select(
            "transaction_id", "transaction_date", "hospital_name", "drug_name", "drug_category", "quantity",
            "performed_by", F.lit("Dispensing Without Prescription").alias("fraud_signal"),
        )
    )


def repeated_claims(claims: DataFrame) -> DataFrame:
    """Patients and visits claimed more than once, with count and sum; partial in every task."""
    return (
        claims.groupBy("patient_id", "visit_id")
        .agg(F.count("claim_id").alias("claim_count"), F.sum("claim_amount").alias("total_claimed"))
        .filter(F.col("claim_count") > 1)
    )


def duplicate_claims(core: Core, claims: DataFrame) -> DataFrame:
    """One row per patient and visit claimed more than once. Core allows one claim per visit, so the rows to look at are staged ones."""
    patient = core["patient"].select("patient_id", person("first_name", "last_name").alias("patient_name"))
    return repeated_claims(claims).join(patient, "patient_id").select(
        "patient_id", "patient_name", "visit_id", "claim_count", "total_claimed",
        F.lit("Duplicate Claim").alias("fraud_signal"),
    )


def duplicate_claim_ids(claims: DataFrame) -> DataFrame:
    """The claims behind ``duplicate_claims``, a row each, so that no list grows with the number of claims."""
    pairs = repeated_claims(claims).select("patient_id", "visit_id")
    return claims.select("patient_id", "visit_id", "claim_id").join(pairs, ["patient_id", "visit_id"])


def expected_quantity() -> Column:
    doses = F.create_map(*[F.lit(x) for pair in DOSES_PER_DAY.items() for x in pair])
    return F.col("duration_days") * F.coalesce(doses[F.col("frequency")], F.lit(1))


def abnormal(core: Core, threshold: float = QUANTITY_LIMIT) -> DataFrame:
    """Prescribed items whose quantity is ``threshold`` times the expected one or more."""
    times = F.col("quantity") * F.lit(Decimal("1.0")) / F.nullif(F.col("expected_quantity"), F.lit(0))
    return (
        core["prescription_item"]
        .withColumn("expected_quantity", expected_quantity())
        .withColumn("times", times)
        .filter(F.col("times") >= decimal(threshold))
    )


def abnormal_rx_quantity(core: Core, threshold: float = QUANTITY_LIMIT) -> DataFrame:
    script = core["prescription"].select("prescription_id", "visit_id", "doctor_id", "prescription_date")
    visit = core["visit"].select("visit_id", "hospital_id", "patient_id")
    patient = core["patient"].select("patient_id", person("first_name", "last_name").alias("patient_name"))
    doctor = core["doctor"].select("doctor_id", person("first_name", "last_name").alias("doctor_name"))
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    drug = core["drug"].select("drug_id", "drug_name")
    return (
        abnormal(core, threshold)
        .join(script, "prescription_id").join(visit, "visit_id").join(patient, "patient_id")
        .join(doctor, "doctor_id").join(hospital, "hospital_id").join(drug, "drug_id")
        .select(
            "prescription_item_id", "prescription_id", "prescription_date", "hospital_id", "hospital_name",
            "doctor_name", "patient_name", "drug_name", "frequency", "duration_days",
            F.col("quantity").alias("actual_quantity"), "expected_quantity",
            rounded(F.col("times")).alias("quantity_multiplier"),
            F.lit("Abnormal Prescription Quantity").alias("fraud_signal"),
        )
    )


def fraud_summary_by_doctor(core: Core) -> DataFrame:
    """Signals per doctor: inflated procedures, abnormal quantities, rejected claims.

    Every signal is counted per visit or prescription before it looks up its doctor. Signals of visits are stacked first, so
    the visits are met once; all counts are then stacked and added up once, so no doctor table is joined three times.
    """
    names = ["inflated_procedure_count", "abnormal_prescription_count", "rejected_claims_count"]

    def counted(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit(name).alias("signal"), "n")

    refused = core["claim_approval"].filter(F.col("approval_status") == "Rejected").select("claim_id")
    rejected = core["claim"].select("claim_id", "visit_id").join(refused, "claim_id")
    of_visits = counted(inflated(core), "visit_id", names[0]).unionByName(counted(rejected, "visit_id", names[2]))
    of_scripts = counted(abnormal(core), "prescription_id", names[1])
    stacked = of_visits.join(core["visit"].select("visit_id", "doctor_id"), "visit_id").drop("visit_id").unionByName(
        of_scripts.join(core["prescription"].select("prescription_id", "doctor_id"), "prescription_id").drop("prescription_id")
    )
    per_doctor = stacked.groupBy("doctor_id").agg(
        *[F.sum(F.when(F.col("signal") == name, F.col("n")).otherwise(0)).alias(name) for name in names],
        F.sum("n").alias("total_fraud_signals"),
    )
    place = core["department"].select("department_id", "hospital_id").join(
        core["hospital"].select("hospital_id", "hospital_name"), "hospital_id"
    ).select("department_id", "hospital_name")
    return (
        core["doctor"].select("doctor_id", "first_name", "last_name", "specialty", "department_id")
        .join(place, "department_id").join(per_doctor, "doctor_id")
        .select(
            "doctor_id", person("first_name", "last_name").alias("doctor_name"), "specialty", "hospital_name",
            *names, "total_fraud_signals",
        )
    )
