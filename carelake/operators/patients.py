"""Patient look-ups and the high-risk list."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import years_between
from carelake.functions.text import folded_value, person
from carelake.schemas import SEVERITIES, core_spelling


def patient_by_national_id(core: Core, national_id: int | str, as_of: date) -> DataFrame:
    return core["patient"].filter(F.col("national_id") == F.lit(int(national_id))).select(
        "patient_id", person("first_name", "last_name").alias("full_name"), "gender", "birth_date",
        years_between("birth_date", F.lit(as_of)).alias("age"), "phone", "city", "street", "blood_type",
        "emergency_contact",
    )


def find_patient(core: Core, national_id: int | str, as_of: date) -> DataFrame:
    """``patient_by_national_id`` that raises when nobody has that number."""
    found = patient_by_national_id(core, national_id, as_of)
    if found.isEmpty():
        raise LookupError(f"national id {national_id} is not on file")
    return found


def visits_of(core: Core, patient_id: str) -> DataFrame:
    return core["visit"].filter(F.col("patient_id") == folded_value(patient_id))


def patient_visit_history(core: Core, patient_id: str) -> DataFrame:
    """The patient's visits; the key filter reaches the scan before any join."""
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    department = core["department"].select("department_id", "department_name")
    doctor = core["doctor"].select("doctor_id", person("first_name", "last_name").alias("doctor_name"))
    return (
        visits_of(core, patient_id)
        .join(doctor, "doctor_id")
        .join(department, "department_id")
        .join(hospital, "hospital_id")
        .join(core["diagnosis"], "diagnosis_code")
        .select(
            "visit_id", "visit_date", "visit_type", "visit_status", "hospital_name", "department_name",
            "doctor_name", "diagnosis_name", "diagnosis_category", "severity_level", "symptoms",
            "waiting_time", "total_amount",
        )
    )


def patient_prescription_history(core: Core, patient_id: str) -> DataFrame:
    """Every drug prescribed at one of the patient's visits.

    The patient's few prescriptions are found first and joined to the items; adaptive execution broadcasts them when they fit.
    """
    visits = visits_of(core, patient_id).select("visit_id")
    scripts = core["prescription"].join(visits, "visit_id", "left_semi")
    scripts = scripts.select("prescription_id", "prescription_date")
    drug = core["drug"].select("drug_id", "drug_name", "generic_name")
    return (
        core["prescription_item"]
        .join(scripts, "prescription_id")
        .join(drug, "drug_id")
        .select(
            "prescription_id", "prescription_date", "drug_id", "drug_name", "generic_name", "dosage",
            "frequency", "duration_days", "quantity",
        )
    )


def high_risk_patients(core: Core, as_of: date, min_visits: int = 3, severity: str = "Severe") -> DataFrame:
    """Patients with at least ``min_visits`` completed visits for one severity.

    Visits are counted per patient before the patient table is touched, so only patients
    over the limit are joined and a patient with very many visits is counted in parts.
    """
    severe = core["diagnosis"].filter(F.col("severity_level") == core_spelling(SEVERITIES, severity))
    counted = (
        core["visit"]
        .filter(F.col("visit_status") == "Completed")
        .join(severe.select("diagnosis_code"), "diagnosis_code", "left_semi")
        .groupBy("patient_id")
        .agg(F.count(F.lit(1)).alias("total_visits"), F.max("visit_date").alias("last_visit"))
        .filter(F.col("total_visits") >= min_visits)
    )
    return core["patient"].join(counted, "patient_id").select(
        "patient_id", person("first_name", "last_name").alias("full_name"), "gender",
        years_between("birth_date", F.lit(as_of)).alias("age"), "phone", "total_visits", "last_visit",
    )
