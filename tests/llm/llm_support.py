"""Shared by the tests of this folder."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"


def table_rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if not isinstance(x, list) else str(x)) for x in r))
