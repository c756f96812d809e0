"""The domain views as DuckDB common table expressions."""

from __future__ import annotations

from carelake.sources.driver_tables import FILES, VIEWS, placeholders

WINGS = "SELECT hospital_no, hospital_id, unnest([0, 1, 2, 3, 4]) AS dk FROM {hospital}"


def text_of(name: str, extra: dict[str, str]) -> str:
    if name in extra:
        return extra[name]
    return WINGS if name == "hospital_wing" else VIEWS[name]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with its ``{view}`` placeholders resolved, preceded by every CTE it needs.

    ``extra`` adds views of the query's own; they may use the domain views and one another.
    """
    extra = extra or {}
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in ordered or (name in FILES and name not in extra):
            return
        text = text_of(name, extra)
        for dep in placeholders(text):
            add(dep)
        ordered[name] = bind(text)

    def bind(text: str) -> str:
        return text.format(**{dep: dep for dep in placeholders(text)})

    for dep in placeholders(body):
        add(dep)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in ordered.items())
    return f"WITH {ctes}\nSELECT * FROM ({bind(body)}) result" if ctes else bind(body)
