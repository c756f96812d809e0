"""Stock alerts and drug consumption."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.core import Core
from carelake.functions.figures import month_of, months_before, within
from carelake.functions.text import folded_value
from carelake.operators.views import stock_with_names


def at_hospital(rows: DataFrame, hospital_id: str | None) -> DataFrame:
    return rows if hospital_id is None else rows.filter(F.col("hospital_id") == folded_value(hospital_id))


def low_stock(core: Core, hospital_id: str | None = None) -> DataFrame:
    """Inventory at or below its reorder level."""
    short = at_hospital(stock_with_names(core), hospital_id).filter(
        F.col("quantity_available") <= F.col("reorder_level")
    )
    return short.select(
        "hospital_name", "drug_id", "drug_name", "drug_category", "quantity_available", "reorder_level",
        (F.col("reorder_level") - F.col("quantity_available")).alias("shortage_units"), "expiration_date",
        F.when(F.col("quantity_available") == 0, "OUT OF STOCK").otherwise("LOW STOCK").alias("alert_type"),
    )


def expiring_soon(core: Core, as_of: date, days: int = 60, hospital_id: str | None = None) -> DataFrame:
    """Stock on hand that expires after today and within ``days`` days."""
    expiry = F.col("expiration_date")
    soon = at_hospital(stock_with_names(core), hospital_id).filter(
        (expiry > F.lit(as_of)) & (expiry <= F.lit(as_of + timedelta(days=days))) & (F.col("quantity_available") > 0)
    )
    return soon.select(
        "hospital_name", "drug_name", "drug_category", "quantity_available", "expiration_date",
        F.datediff(expiry, F.lit(as_of)).alias("days_to_expiry"),
    )


def drug_consumption(
    core: Core, as_of: date, hospital_id: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Dispensed quantity per hospital, drug and month (default: six months).

    Summed per key and month before the names are joined, then once more per name, since
    two drugs may share one.
    """
    start, end = start or months_before(as_of, 6), end or as_of
    moves = within(core["drug_transaction"], "transaction_date", start, end)
    dispensed = at_hospital(moves, hospital_id).filter(F.col("transaction_type") == "Dispensing")
    summed = dispensed.groupBy("hospital_id", "drug_id", month_of("transaction_date").alias("month")).agg(
        F.sum("quantity").alias("q"), F.count(F.lit(1)).alias("n")
    )
    drug = core["drug"].select("drug_id", "drug_name", "drug_category")
    hospital = core["hospital"].select("hospital_id", "hospital_name")
    return (
        summed.join(drug, "drug_id").join(hospital, "hospital_id")
        .groupBy("hospital_name", "drug_name", "drug_category", "month")
        .agg(F.sum("q").alias("total_dispensed"), F.sum("n").alias("transaction_count"))
    )
