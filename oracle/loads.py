"""The load rules as set-based DuckDB SQL: rows that pass every condition, and those that do not."""

from __future__ import annotations

from carelake.functions.text import DECIMAL_PATTERN, PATTERNS
from carelake.schemas import BY_NAME, TABLES, Col, Table
from carelake.sources.staging import in_core_text, staged_text
from oracle.domain import with_views
from oracle.hand_rules import HAND, hand_judged


def read_as(text: str, sql_type: str) -> str:
    pattern = PATTERNS.get(sql_type, DECIMAL_PATTERN).removeprefix("^").removesuffix("$")
    pattern = pattern.replace("{", "{{").replace("}", "}}")
    target = "TIMESTAMP" if sql_type == "timestamp_ntz" else sql_type.upper()
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN TRY_CAST(trim({text}) AS {target}) END"


def value(c: Col, table: Table) -> str:
    text = f"s_{c.name}"
    if c.currency:
        text = f"replace(replace(replace({text}, ',', ''), 'EGP', ''), 'egp', '')"
    if c.name in table.key_columns:
        return f"nullif(upper(rtrim({text})), '')"
    if c.via:
        text = f"CAST(TRY_CAST({read_as(text, 'decimal(18,0)')} AS {c.via.upper()}) AS VARCHAR)"
    elif c.type != "string":
        return read_as(text, c.type)
    if c.domain:
        whens = " ".join(f"WHEN '{v.upper()}' THEN '{v}'" for v in c.domain)
        return f"CASE upper(rtrim({text})) {whens} END"
    return f"coalesce({text}, '{c.default}')" if c.default else text


def broken(
    table: Table, parents: dict[str, str], own: str | None, check_widths: bool = False
) -> list[tuple[str, str]]:
    """(condition, code) for every rule; in row ``r``, ``s_`` columns are staged text and ``t_`` columns core values."""
    found = []
    for c in table.columns:
        text, core = f"r.s_{c.name}", f"r.t_{c.name}"
        if c.required and not c.default:
            found.append((f"{core if c.name in table.key_columns else text} IS NULL", f"null:{c.name}"))
        if (c.type != "string" or c.via) and not c.soft and not c.domain:
            found.append((f"{text} IS NOT NULL AND {core} IS NULL", f"cast:{c.name}"))
        bounds = [f"{core} < {c.low}"] if c.low else []
        bounds += [f"{core} > {c.high}"] if c.high else []
        if bounds:
            found.append((" OR ".join(bounds), f"range:{c.name}"))
        if c.domain:
            found.append((f"{text} IS NOT NULL AND {core} IS NULL", f"domain:{c.name}"))
        if check_widths and c.width:
            found.append((f"length(rtrim({core if c.via else text})) > {c.width}", f"length:{c.name}"))
    if table.differ:
        found.append((f"r.t_{table.differ[0]} = r.t_{table.differ[1]}", "check:from_to"))
    if table.one_of:
        a, b = table.one_of
        found.append((f"(r.t_{a} IS NULL) = (r.t_{b} IS NULL)", "check:xor"))
    for r in table.refs:
        parent = parents[r.table]
        found.append((
            f"r.t_{r.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {{{parent}}} p WHERE p.{r.key} = r.t_{r.column})",
            r.reason,
        ))
    if own:
        for names in table.uniques:
            same = " AND ".join(f"p.{n} = r.t_{n}" for n in names)
            found.append((f"EXISTS (SELECT 1 FROM {{{own}}} p WHERE {same})", "unique:" + "+".join(names)))
    return found


def judged_text(table: Table, parents: dict[str, str], own: str | None, check_widths: bool = False) -> str:
    """Core values, staged key, joined reasons, the staged row and whether the key was loaded before.

    One pass: staged text and core values stand side by side in a row under names of their own. The largest tables have rules written by hand.
    """
    if table.name in HAND and not check_widths:
        return hand_judged(table.name, parents, own)
    staged = ", ".join(f"nullif({c}, '') AS s_{c}" for c in table.column_names)
    values = ", ".join(f"{value(c, table)} AS t_{c.name}" for c in table.columns)
    codes = ", ".join(
        f"CASE WHEN {rule} THEN '{code}' END" for rule, code in broken(table, parents, own, check_widths)
    )
    fields = ", ".join(f"'{c}': r.s_{c}" for c in table.column_names)
    known = f"EXISTS (SELECT 1 FROM {{{own}}} k WHERE k.{table.key} = r.t_{table.key})" if own else "FALSE"
    return f"""
        SELECT {', '.join(f't_{c} AS {c}' for c in table.column_names)},
               s_{table.key} AS source_key,
               concat_ws(',', {codes}) AS reasons,
               CAST(to_json({{{{{fields}}}}}) AS VARCHAR) AS raw_data,
               {known} AS known
        FROM (SELECT *, {values} FROM (SELECT {staged} FROM {{stg_{table.name}}}) x) r"""


def single_table(name: str, check_widths: bool = False) -> dict[str, str]:
    """Extra views for one table's load onto a partly loaded core with clean parents."""
    table = BY_NAME[name]
    parents = {r.table: r.table for r in table.refs}
    return {
        f"stg_{name}": staged_text(table),
        f"before_{name}": in_core_text(table),
        f"judged_{name}": judged_text(table, parents, f"before_{name}", check_widths),
    }


def accepted_sql(name: str, check_widths: bool = False) -> str:
    columns = ", ".join(BY_NAME[name].column_names)
    body = f"SELECT {columns} FROM {{judged_{name}}} WHERE NOT known AND reasons = ''"
    return with_views(body, single_table(name, check_widths))


def quarantine_sql(name: str, check_widths: bool = False) -> str:
    body = f"""SELECT '{BY_NAME[name].full_name}' AS target_table, source_key, reasons, raw_data
        FROM {{judged_{name}}} WHERE NOT known AND reasons <> ''"""
    return with_views(body, single_table(name, check_widths))


def cascade() -> dict[str, str]:
    """Extra views for the load of all tables into an empty core, parents before children."""
    views: dict[str, str] = {}
    for table in TABLES:
        parents = {r.table: f"accepted_{r.table}" for r in table.refs}
        views[f"stg_{table.name}"] = staged_text(table)
        views[f"judged_{table.name}"] = judged_text(table, parents, None)
        columns = ", ".join(table.column_names)
        views[f"accepted_{table.name}"] = f"SELECT {columns} FROM {{judged_{table.name}}} WHERE reasons = ''"
    return views


def all_tables(select: str) -> str:
    """UNION ALL of one SELECT per table, over the cascade."""
    parts = [
        select.format(schema=t.schema, name=t.name, full=t.full_name, stg="{stg_" + t.name + "}",
                      judged="{judged_" + t.name + "}", accepted="{accepted_" + t.name + "}")
        for t in TABLES
    ]
    return with_views("\nUNION ALL\n".join(parts), cascade())


def load_all_sql() -> str:
    return all_tables("""SELECT '{full}' AS target_table, count(*) AS staged,
        count(*) FILTER (reasons = '') AS accepted, count(*) FILTER (reasons <> '') AS quarantined FROM {judged}""")


def row_counts_sql() -> str:
    return all_tables("SELECT '{schema}' AS schema_name, '{name}' AS table_name, count(*) AS row_count FROM {accepted}")


def pending_sql() -> str:
    return all_tables("SELECT 'stg.{name}' AS stg_table, count(*) FILTER (reasons <> '') AS pending FROM {judged}")


def errors_sql(moment: str) -> str:
    return all_tables(
        "SELECT '{full}' AS target_table, count(*) AS error_count,"
        f" TIMESTAMP '{moment}' AS first_error, TIMESTAMP '{moment}' AS last_error"
        " FROM {judged} WHERE reasons <> '' HAVING count(*) > 0"
    )


def staged_sql(name: str) -> str:
    return with_views(f"SELECT * FROM {{stg_{name}}}", {f"stg_{name}": staged_text(BY_NAME[name])})


def ingest_csv_sql() -> str:
    parts = []
    for t in TABLES:
        width = " + ".join(f"coalesce(length({c}), 0)" for c in t.column_names)
        parts.append(
            f"SELECT 'stg.{t.name}' AS stg_table, count(*) AS row_count, CAST(sum({width}) AS BIGINT) AS characters"
            f" FROM {{stg_{t.name}}}"
        )
    return with_views("\nUNION ALL\n".join(parts), {f"stg_{t.name}": staged_text(t) for t in TABLES})
