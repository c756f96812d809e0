"""Insurance claims: listing by status and the reasons for rejection."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import months_before, percent, rounded, within
from carelake.functions.text import folded, person
from carelake.operators.pharmacy import at_hospital
from carelake.schemas import CLAIM_STATES, core_spelling


def claims_by_status(
    core: Core,
    as_of: date,
    status: str | None = None,
    hospital_id: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Claims of a period (default: one month), optionally of one status or hospital."""
    start, end = start or months_before(as_of, 1), end or as_of
    claims = at_hospital(within(core["claim"], "claim_date", start, end), hospital_id)
    if status is not None:
        claims = claims.filter(F.col("claim_status") == core_spelling(CLAIM_STATES, status))
    patient = core["patient"].select("patient_id", person("first_name", "last_name").alias("patient_name"))
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    review = core["claim_approval"].select("claim_id", "reviewed_by", "approval_date", "rejection_reason")
    return (
        claims.join(review, "claim_id", "left").join(patient, "patient_id").join(hospital, "hospital_id")
        .select(
            "claim_id", "patient_name", "hospital_name", "claim_date", "claim_amount", "approved_amount",
            "claim_status", "reviewed_by", "approval_date", "rejection_reason",
        )
    )


def rejection_reasons(core: Core, as_of: date, start: date | None = None, end: date | None = None) -> DataFrame:
    """How often each reason was given and its share of all (default: six months).

    The total is a scalar subquery over the counted reasons, not a window over one partition.
    """
    start, end = start or months_before(as_of, 6), end or as_of
    counted = (
        within(core["claim_approval"], "approval_date", start, end)
        .filter((F.col("approval_status") == "Rejected") & F.col("rejection_reason").isNotNull())
        .groupBy(folded("rejection_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("total_rejections"), F.min("rejection_reason").alias("rejection_reason"))
    )
    total = counted.select(F.sum("total_rejections")).scalar()
    return counted.select(
        "rejection_reason", "total_rejections",
        rounded(percent(F.col("total_rejections"), total)).alias("pct_of_all_rejections"),
    )
