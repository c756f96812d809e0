"""Text comparison and conversion as the core tables understand it.

The reference compares text without regard to case or trailing blanks. Keys and domain
values are therefore brought to one spelling when they are loaded; after that, joins and
filters are plain equality, so they hash, bucket and push down to Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: accepted spellings of numbers, days and points in time.
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
DECIMAL_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
DAY_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
MOMENT_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,7})?)?)?\s*$"

PATTERNS = {
    "smallint": INTEGER_PATTERN,
    "int": INTEGER_PATTERN,
    "bigint": INTEGER_PATTERN,
    "date": DAY_PATTERN,
    "timestamp_ntz": MOMENT_PATTERN,
}


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def folded(value: str | Column) -> Column:
    """The spelling under which two texts count as equal."""
    return F.upper(F.rtrim(col(value)))


def folded_value(value: str | None) -> str | None:
    """``folded`` for a parameter; ``None`` stays ``None``."""
    return None if value is None else value.rstrip(" ").upper()


def person(first: str | Column, last: str | Column) -> Column:
    """First and last name; NULL when either is NULL."""
    return F.concat(col(first), F.lit(" "), col(last))


def parsed(value: str | Column, sql_type: str) -> Column:
    """``value`` as ``sql_type``, or NULL when it is not a full, plain spelling of one."""
    text = col(value)
    pattern = PATTERNS.get(sql_type, DECIMAL_PATTERN)
    return F.when(text.rlike(pattern), F.trim(text).try_cast(sql_type))


def numbered(prefix: str, number: Column, digits: int) -> Column:
    """Prefix plus a zero-padded number; a number of more digits keeps them all."""
    text = number.cast("string")
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(digits) - F.length(text)))
    return F.concat(F.lit(prefix), zeros, text)


def number_in(column: str, prefix: str) -> Column:
    """The number in an id of this prefix; NULL for an id of another form."""
    return F.when(F.col(column).startswith(prefix), parsed(F.substr(F.col(column), F.lit(len(prefix) + 1)), "bigint"))
