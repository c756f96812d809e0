"""Beds, ICU, doctors' workload, referrals and the hospital score card."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from carelake.core import Core
from carelake.functions.figures import flag_count, mean, month_of, months_before, percent, rounded, within
from carelake.functions.text import folded, folded_value, person
from carelake.plans.session import written


def newest_of(snapshots: DataFrame) -> DataFrame:
    """The newest of these snapshots for each hospital.

    The maximum of a struct led by the time is an aggregate, so each task keeps one row per
    hospital; ranking the snapshots would send a busy hospital's whole history to one task.
    """
    newest = F.max(F.struct("update_time", "icu_status_id", "occupied_beds", "available_beds"))
    return snapshots.groupBy("hospital_id").agg(newest.alias("s")).select(
        "hospital_id",
        F.col("s.occupied_beds").alias("icu_occupied"),
        F.col("s.available_beds").alias("icu_available"),
        F.col("s.update_time").alias("last_snapshot"),
    )


def latest_icu(core: Core) -> DataFrame:
    """The newest ICU snapshot of each hospital.

    Snapshots stored by month are read from the newest month backwards, a month only for the hospitals that no later one
    knows, and no further than all hospitals are found; the reading of earlier months is the exception.
    """
    snapshots = core["icu_status"]
    if "ym" not in snapshots.columns:
        return newest_of(snapshots)
    months = sorted((r.ym for r in snapshots.select("ym").distinct().collect()), reverse=True)
    wanted, parts = core["hospital"].select("hospital_id"), []
    for month in months:
        found = newest_of(snapshots.filter(F.col("ym") == month).join(wanted, "hospital_id", "left_semi"))
        found = written(found, f"icu-{month}")
        parts.append(found)
        wanted = written(wanted.join(found, "hospital_id", "left_anti"), "hospitals-without-snapshot")
        if wanted.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts) if parts else newest_of(snapshots)


def hospital_capacity(core: Core) -> DataFrame:
    """Bed and ICU occupancy of every hospital, also of those without beds or snapshots."""
    beds = core["bed"].groupBy("hospital_id").agg(
        F.count(F.lit(1)).alias("total_bed_records"),
        flag_count(F.col("availability_status") == "Occupied").alias("occupied_beds"),
        flag_count(F.col("availability_status") == "Available").alias("available_beds"),
    )
    none = F.lit(0).cast("bigint")
    counts = ["total_bed_records", "occupied_beds", "available_beds"]
    return (
        core["hospital"]
        .join(beds, "hospital_id", "left")
        .join(latest_icu(core), "hospital_id", "left")
        .withColumns({c: F.coalesce(F.col(c), none) for c in counts})
        .select(
            "hospital_id", "hospital_name", "hospital_type", "total_beds", *counts,
            rounded(percent(F.col("occupied_beds"), F.col("total_bed_records"))).alias("occupancy_pct"),
            "icu_occupied", "icu_available", "icu_capacity",
            rounded(percent(F.col("icu_occupied"), F.col("icu_capacity"))).alias("icu_occupancy_pct"),
        )
    )


def icu_alerts(core: Core, threshold: float = 80.0) -> DataFrame:
    """Hospitals whose newest snapshot shows at least ``threshold`` percent (after rounding)."""
    return (
        core["hospital"]
        .join(latest_icu(core), "hospital_id")
        .withColumn("icu_occupancy_pct", rounded(percent(F.col("icu_occupied"), F.col("icu_capacity"))))
        .filter(F.col("icu_occupancy_pct") >= F.lit(threshold).cast("decimal(12,1)"))
        .select(
            "hospital_id", "hospital_name", "district", "icu_capacity",
            F.col("icu_occupied").alias("occupied_beds"), F.col("icu_available").alias("available_beds"),
            "icu_occupancy_pct", "last_snapshot",
        )
    )


def doctor_workload(
    core: Core, as_of: date, hospital_id: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Visits, shifts and double shifts of every doctor in a period (default: one month).

    Visits and shifts are reduced to one row per doctor separately; joining them first
    would multiply a doctor's visits by the doctor's shifts.
    """
    start, end = start or months_before(as_of, 1), end or as_of
    visits = within(core["visit"], "visit_date", start, end).groupBy("doctor_id").agg(
        F.count(F.lit(1)).alias("total_visits")
    )
    days = within(core["doctor_schedule"], "shift_date", start, end).groupBy("doctor_id", "shift_date").agg(
        F.count(F.lit(1)).alias("shifts"),
        flag_count(F.col("shift_start") == "08:00").alias("mornings"),
        flag_count(F.col("shift_start") == "20:00").alias("nights"),
    )
    shifts = days.groupBy("doctor_id").agg(
        F.sum("shifts").alias("total_shifts"),
        F.sum(F.when(F.col("nights") > 0, F.col("mornings")).otherwise(0)).alias("double_shift_days"),
        flag_count(F.col("mornings") > 0).alias("morning_days"),
    )
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    if hospital_id is not None:
        hospital = hospital.filter(F.col("hospital_id") == folded_value(hospital_id))
    place = core["department"].join(hospital, "hospital_id").select("department_id", "hospital_name")

    def or_none(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    return (
        core["doctor"]
        .join(place, "department_id")
        .join(visits, "doctor_id", "left")
        .join(shifts, "doctor_id", "left")
        .select(
            "doctor_id", person("first_name", "last_name").alias("doctor_name"), "specialty", "hospital_name",
            or_none("total_visits").alias("total_visits"),
            or_none("total_shifts").alias("total_shifts"),
            or_none("double_shift_days").alias("double_shift_days"),
            rounded(percent(or_none("double_shift_days"), F.col("morning_days"))).alias("double_shift_pct"),
        )
    )


def referral_summary(core: Core, as_of: date, start: date | None = None, end: date | None = None) -> DataFrame:
    """Referrals per pair of hospital names, reason and status (default: three months).

    Counted per hospital key first; the names are put on the few counted rows.
    """
    start, end = start or months_before(as_of, 3), end or as_of
    counted = (
        within(core["referral"], "referral_date", start, end)
        .groupBy("from_hospital_id", "to_hospital_id", folded("referral_reason").alias("reason"), "referral_status")
        .agg(F.count(F.lit(1)).alias("n"), F.min("referral_reason").alias("referral_reason"))
    )
    hospital = core["hospital"]
    origin = hospital.select(F.col("hospital_id").alias("from_hospital_id"), F.col("hospital_name").alias("from_hospital"))
    target = hospital.select(F.col("hospital_id").alias("to_hospital_id"), F.col("hospital_name").alias("to_hospital"))
    return (
        counted.join(origin, "from_hospital_id").join(target, "to_hospital_id")
        .groupBy("from_hospital", "to_hospital", "reason", "referral_status")
        .agg(F.sum("n").alias("total_referrals"), F.min("referral_reason").alias("referral_reason"))
        .select("from_hospital", "to_hospital", "referral_reason", "referral_status", "total_referrals")
    )


def hospital_performance(core: Core) -> DataFrame:
    """Rating, waiting time, claim rejections and outgoing referrals of every hospital.

    Four facts, each reduced to one row per hospital before they meet; nothing is joined
    fact to fact except a claim to its own review.
    """
    feedback = core["patient_feedback"].groupBy("hospital_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("ratings"),
        F.count(F.lit(1)).alias("total_feedback"),
    )
    waits = core["visit"].filter(F.col("visit_status") == "Completed").groupBy("hospital_id").agg(
        F.sum("waiting_time").alias("wait_sum"), F.count("waiting_time").alias("waits")
    )
    rejected = (
        core["claim_approval"].filter(F.col("approval_status") == "Rejected")
        .select("claim_id", F.lit(True).alias("was_rejected"))
    )
    claims = core["claim"].select("claim_id", "hospital_id").join(rejected, "claim_id", "left").groupBy("hospital_id").agg(
        F.count("was_rejected").alias("rejected_claims"), F.count(F.lit(1)).alias("total_claims")
    )
    referrals = core["referral"].groupBy(F.col("from_hospital_id").alias("hospital_id")).agg(
        F.count(F.lit(1)).alias("total_referrals_out")
    )
    counts = ["total_feedback", "rejected_claims", "total_claims", "total_referrals_out"]
    return (
        core["hospital"].select("hospital_id", "hospital_name", "hospital_type", "district")
        .join(feedback, "hospital_id", "left")
        .join(waits, "hospital_id", "left")
        .join(claims, "hospital_id", "left")
        .join(referrals, "hospital_id", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in counts})
        .select(
            "hospital_id", "hospital_name", "hospital_type", "district",
            rounded(mean(F.col("rating_sum"), F.col("ratings")), 3, 1).alias("avg_rating"),
            "total_feedback",
            rounded(mean(F.col("wait_sum"), F.col("waits"))).alias("avg_waiting_min"),
            "rejected_claims", "total_claims",
            rounded(percent(F.col("rejected_claims"), F.col("total_claims"))).alias("rejection_rate_pct"),
            "total_referrals_out",
        )
    )


def monthly_visits(core: Core, hospital_id: str | None = None) -> DataFrame:
    """Completed visits per month against the previous month that has any."""
    visits = core["visit"].filter(F.col("visit_status") == "Completed")
    if hospital_id is not None:
        visits = visits.filter(F.col("hospital_id") == folded_value(hospital_id))
    kinds = {"emergency_visits": "Emergency", "inpatient_visits": "Inpatient", "outpatient_visits": "Outpatient"}
    months = visits.groupBy(month_of("visit_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_visits"),
        *[flag_count(F.col("visit_type") == kind).alias(name) for name, kind in kinds.items()],
        F.sum("waiting_time").alias("wait_sum"), F.count("waiting_time").alias("waits"),
        F.sum("total_amount").alias("cost_sum"), F.count("total_amount").alias("costs"),
    )
    # One row per calendar month: the only place where all rows meet in one task.
    before = F.lag("total_visits").over(Window.orderBy("month"))
    return months.withColumn("prev_month_visits", before).select(
        "month", "total_visits", *kinds,
        rounded(mean(F.col("wait_sum"), F.col("waits"))).alias("avg_waiting_time_min"),
        rounded(mean(F.col("cost_sum"), F.col("costs")), 12, 2).alias("avg_visit_cost_egp"),
        "prev_month_visits",
        rounded(
            percent(F.col("total_visits") - F.col("prev_month_visits"), F.col("prev_month_visits"))
        ).alias("mom_change_pct"),
    )


def top_diagnoses(core: Core, n: int = 5, hospital_id: str | None = None) -> DataFrame:
    """The ``n`` most frequent diagnoses of each hospital; equal counts rank by name.

    Visits are counted per hospital and code first, so ranking only sees one row per
    hospital and diagnosis.
    """
    visits = core["visit"].filter(F.col("visit_status") == "Completed")
    if hospital_id is not None:
        visits = visits.filter(F.col("hospital_id") == folded_value(hospital_id))
    named = ["diagnosis_name", "diagnosis_category", "severity_level"]
    counted = (
        visits.groupBy("hospital_id", "diagnosis_code").agg(F.count(F.lit(1)).alias("n"))
        .join(core["diagnosis"], "diagnosis_code")
        .groupBy("hospital_id", *named).agg(F.sum("n").alias("visit_count"))
    )
    order = Window.partitionBy("hospital_id").orderBy(F.desc("visit_count"), *named)
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return (
        counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
        .join(hospital, "hospital_id")
        .select("hospital_name", *named, "visit_count", "rank")
    )
