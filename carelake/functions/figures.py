"""Figures and calendar arithmetic used by the reports."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.text import col

HUNDRED = Decimal("100.0")


def percent(part: Column, whole: Column) -> Column:
    """Unrounded ``part * 100 / whole`` in decimal arithmetic; NULL when ``whole`` is 0."""
    return part * F.lit(HUNDRED) / F.nullif(whole, F.lit(0))


def rounded(value: Column, precision: int = 12, scale: int = 1) -> Column:
    """Half-up to ``scale`` places, wide enough that no single row can overflow."""
    return value.cast(f"decimal({precision},{scale})")


def mean(total: Column, count: Column) -> Column:
    """Exact decimal mean; independent of the order in which tasks add up."""
    return total.cast("decimal(28,2)") / F.nullif(count, F.lit(0)).cast("decimal(18,0)")


def years_between(earlier: str | Column, later: str | Column) -> Column:
    """Calendar-year boundaries crossed, which is how the reference states an age."""
    return F.year(col(later)) - F.year(col(earlier))


def month_of(day: str | Column) -> Column:
    return F.date_format(col(day), "yyyy-MM")


def flag_count(condition: Column) -> Column:
    """Number of rows for which ``condition`` holds; 0 for an empty group."""
    return F.count(F.when(condition, 1))


def moment(at: datetime) -> Column:
    """A point in time as a literal that does not depend on any time zone setting."""
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def months_before(day: date, months: int) -> date:
    """The same day of an earlier month, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    for candidate in (day.day, 30, 29, 28):
        try:
            return date(year, month + 1, min(day.day, candidate))
        except ValueError:
            continue
    raise ValueError(day)


def within(df: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """Rows whose ``day`` lies in the closed range.

    Stored facts are partitioned by ``ym``; the month bounds let Spark skip whole folders.
    """
    if "ym" in df.columns:
        df = df.filter(F.col("ym").between(start.strftime("%Y-%m"), end.strftime("%Y-%m")))
    return df.filter(F.col(day).between(F.lit(start), F.lit(end)))
