"""The four standing views.

Dimensions are joined without hints: Spark broadcasts those under its size threshold and
sort-merge joins the rest, where adaptive execution splits a dominant key. The largest
partner comes first, while the fact rows are still narrow.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import percent, rounded, years_between
from carelake.functions.text import person

NEAR_EXPIRY_DAYS = 60


def visit_detail(core: Core) -> DataFrame:
    """Each visit with its patient, hospital, doctor, department and diagnosis."""
    patient = core["patient"].select(
        "patient_id", person("first_name", "last_name").alias("patient_name"), "gender", "birth_date", "blood_type"
    )
    doctor = core["doctor"].select(
        "doctor_id", person("first_name", "last_name").alias("doctor_name"), "specialty"
    )
    hospital = core["hospital"].select("hospital_id", "hospital_name", "hospital_type", "district")
    department = core["department"].select("department_id", "department_name")
    return (
        core["visit"]
        .join(patient, "patient_id")
        .join(doctor, "doctor_id")
        .join(department, "department_id")
        .join(hospital, "hospital_id")
        .join(core["diagnosis"], "diagnosis_code")
        .withColumn("patient_age", years_between("birth_date", "visit_date"))
        .select(
            "visit_id", "visit_date", "visit_type", "visit_status", "waiting_time", "total_amount",
            "symptoms", "patient_id", "patient_name", "gender", "patient_age", "blood_type",
            "hospital_id", "hospital_name", "hospital_type", "district", "doctor_id", "doctor_name",
            "specialty", "department_name", "diagnosis_code", "diagnosis_name", "diagnosis_category",
            "severity_level",
        )
    )


def stock_with_names(core: Core) -> DataFrame:
    """Inventory rows with the names of their drug and hospital."""
    drug = core["drug"].select("drug_id", "drug_name", "drug_category")
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return core["drug_inventory"].join(drug, "drug_id").join(hospital, "hospital_id")


def inventory_alert(core: Core, as_of: date) -> DataFrame:
    """Stock and expiry state of every inventory row; an unknown expiry counts as OK."""
    quantity = F.col("quantity_available")
    horizon = F.lit(as_of + timedelta(days=NEAR_EXPIRY_DAYS))
    return stock_with_names(core).select(
        "inventory_id", "hospital_name", "drug_name", "drug_category",
        "quantity_available", "reorder_level", "expiration_date",
        F.when(quantity == 0, "Stockout")
        .when(quantity <= F.col("reorder_level"), "Low Stock")
        .otherwise("OK")
        .alias("stock_status"),
        F.when(F.col("expiration_date") <= horizon, "Near Expiry").otherwise("OK").alias("expiry_status"),
    )


def claim_summary(core: Core) -> DataFrame:
    """Each claim with its visit, patient, hospital and, if there is one, its review."""
    visit = core["visit"].select("visit_id", "visit_date", "visit_type")
    review = core["claim_approval"].select("claim_id", "approval_date", "reviewed_by", "rejection_reason")
    patient = core["patient"].select("patient_id", person("first_name", "last_name").alias("patient_name"))
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return (
        core["claim"]
        .join(visit, "visit_id")
        .join(review, "claim_id", "left")
        .join(patient, "patient_id")
        .join(hospital, "hospital_id")
        .select(
            "claim_id", "claim_date", "claim_amount", "approved_amount", "claim_status", "approval_date",
            "reviewed_by", "rejection_reason", "patient_name", "hospital_name", "visit_date", "visit_type",
        )
    )


def icu_occupancy_rate(core: Core) -> DataFrame:
    """Every ICU snapshot with the share of the hospital's ICU beds in use."""
    hospital = core["hospital"].select("hospital_id", "hospital_name", "icu_capacity")
    share = percent(F.col("occupied_beds"), F.col("icu_capacity"))
    return core["icu_status"].join(hospital, "hospital_id").select(
        "hospital_id", "hospital_name", "update_time", "occupied_beds", "available_beds", "icu_capacity",
        rounded(share, 12, 2).alias("occupancy_pct"),
    )
