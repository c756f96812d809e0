"""Staged text for the load queries, rendered from the clean domain views.

Every value is turned back into text, as a delivered file would hold it, and a fixed share
of the rows gets one defect each. The defect is chosen by the digits of the row's key, so
the same SELECT gives the same rows in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from carelake.core import Core
from carelake.schemas import (
    BY_NAME,
    DIAGNOSIS_CATEGORIES,
    DISTRICTS,
    PROCEDURE_CATEGORIES,
    Table,
)

# Which defect a row gets: the digits among its key's last six characters modulo SPREAD.
SPREAD = 17
BAD_NUMBER, BAD_CHOICE, NO_PARENT, NO_KEY, LOOSE_SPELLING, IN_CORE, BAD_SOFT, NO_TEXT, OUT_OF_RANGE = range(9)


def one_of(values: tuple[str, ...], number: str) -> str:
    """SQL that picks one of ``values`` by a number."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {whens} END"


def person_of(number: str) -> dict[str, str]:
    """A manager's name and address; some have none."""
    return {
        "manager_name": f"CASE WHEN {number} % 5 <> 4 THEN 'Manager ' || CAST({number} AS STRING) END",
        "manager_email": f"CASE WHEN {number} % 3 <> 1 THEN 'm' || CAST({number} AS STRING) || '@example.org' END",
    }


AMOUNT = "CAST(expected_amount AS STRING)"
# What is staged where the domain views have no value, or none that the rules permit. Some of it cannot be read.
STAGED_AS = {
    ("diagnosis", "diagnosis_category"): one_of(DIAGNOSIS_CATEGORIES, "length(diagnosis_name)"),
    ("medical_procedure", "procedure_category"): one_of(PROCEDURE_CATEGORIES, "part_no"),
    ("medical_procedure", "expected_amount"): f"""CASE WHEN length({AMOUNT}) = 7 THEN left({AMOUNT}, 1) || ',' || right({AMOUNT}, 6) || ' egp'
        ELSE 'EGP' || {AMOUNT} END""",
    ("hospital", "district"): one_of(DISTRICTS, "hospital_no"),
    ("hospital", "longitude"): "CASE hospital_no % 6 WHEN 1 THEN 'east' WHEN 2 THEN '' ELSE ' 32.' || CAST(hospital_no * 12345 AS STRING) END",
    ("hospital", "latitude"): "CASE hospital_no % 6 WHEN 1 THEN '31,25' WHEN 3 THEN '-31.2' ELSE '31.' || CAST(hospital_no * 7654321 AS STRING) END",
    ("hospital", "manager_phone"): "'+20 66 ' || CAST(hospital_no AS STRING)",
    ("department", "manager_phone"): """CASE department_no % 7 WHEN 1 THEN 'ext. 5' WHEN 2 THEN '' WHEN 3 THEN '0100200.7' WHEN 4 THEN CAST(NULL AS STRING)
        ELSE '0' || CAST(1000000000 + department_no AS STRING) END""",
    ("doctor", "phone"): "CASE WHEN doctor_no % 4 <> 3 THEN '010-' || CAST(doctor_no AS STRING) END",
    ("patient", "governorate"): "CASE patient_no % 4 WHEN 0 THEN 'Cairo' WHEN 2 THEN 'Ismailia ' END",
    **{("hospital", c): text for c, text in person_of("hospital_no").items()},
    **{("department", c): text for c, text in person_of("department_no").items()},
}


def defect(table: Table) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ-"
    return f"CAST(translate(right({table.key}, 6), '{letters}', '') AS INT) % {SPREAD}"


def staged_text(table: Table) -> str:
    """SELECT that renders a domain view as staged text with its defects."""
    refs = [r.column for r in table.refs]
    hard = next((c.name for c in table.columns if c.type != "string" and not c.soft), None)
    ranged = next((c.name for c in table.columns if c.low), None)
    chosen = next((c.name for c in table.columns if c.domain), None)
    soft = next((c.name for c in table.columns if c.soft), None)
    plain = next((c.name for c in table.columns[1:] if c.required and c.name not in refs), None)
    items = []
    for c in table.columns:
        text = STAGED_AS.get((table.name, c.name), f"CAST({c.name} AS STRING)")
        whens = []
        if c.name == hard:
            whens.append((BAD_NUMBER, "'n/a'"))
        if c.name == chosen:
            whens.append((BAD_CHOICE, "'Huge'"))
        if refs and c.name == refs[0]:
            whens.append((NO_PARENT, "'NONE999'"))
        if c.name == table.key:
            whens.append((NO_KEY, "CAST(NULL AS STRING)"))
        if c.domain or c.name in refs:
            whens.append((LOOSE_SPELLING, f"lower({text}) || '  '"))
        if c.name == soft:
            whens.append((BAD_SOFT, "'soon'"))
        if c.name == plain:
            whens.append((NO_TEXT, "CAST(NULL AS STRING)"))
        if c.name == ranged:
            whens.append((OUT_OF_RANGE, "'-1'"))
        cases = " ".join(f"WHEN {code} THEN {value}" for code, value in whens)
        items.append(f"CASE k {cases} ELSE {text} END AS {c.name}" if cases else f"{text} AS {c.name}")
    return f"SELECT {', '.join(items)} FROM (SELECT *, {defect(table)} AS k FROM {{{table.name}}}) x"


def in_core_text(table: Table) -> str:
    """Clean rows that count as loaded before: the keys of one defect class."""
    return f"SELECT * FROM {{{table.name}}} WHERE {defect(table)} = {IN_CORE}"


def staged_table(core: Core, name: str) -> DataFrame:
    return core.spark.sql(staged_text(BY_NAME[name]), **{name: core[name]})


def partly_loaded(core: Core, name: str) -> DataFrame:
    return core.spark.sql(in_core_text(BY_NAME[name]), **{name: core[name]})
