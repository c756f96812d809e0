from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from carelake.core import Core  # noqa: E402
from carelake.plans.session import discard_written, local_session  # noqa: E402
from carelake.schemas import BY_NAME  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Small test data would be merged into one partition; keep several, as a cluster has.
    session = local_session(4, "4g", **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    yield session
    discard_written(session)


@pytest.fixture(scope="session")
def staged(spark):
    """Make a staged table from dicts; columns not given are NULL."""

    def make(name: str, rows: list[dict]):
        columns = BY_NAME[name].column_names
        return spark.createDataFrame(
            [tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns)
        )

    return make


@pytest.fixture(scope="session")
def core_of(spark):
    """Make core tables from dicts of name -> rows; types come from the table rules."""

    def make(tables: dict[str, list[dict]]) -> Core:
        frames = {}
        for name, rows in tables.items():
            columns = BY_NAME[name].columns
            text = spark.createDataFrame(
                [tuple(None if r.get(c.name) is None else str(r[c.name]) for c in columns) for r in rows],
                ", ".join(f"{c.name} string" for c in columns),
            )
            frames[name] = text.selectExpr(*[f"CAST({c.name} AS {c.type}) AS {c.name}" for c in columns])
        return Core(spark, frames)

    return make
