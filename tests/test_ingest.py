"""The delivery of all tables leaves little on disk at a time."""

from __future__ import annotations

import os

import registry
from carelake.plans.session import scratch_folder
from carelake.schemas import TABLES

SF = "/root/testdata/sf0.001"


def test_delivered_files_are_counted_and_deleted_by_slice(spark, monkeypatch):
    deliver, seen = registry.delivered, []

    def noted(core, name, *rest):
        path = deliver(core, name, *rest)
        held = {f for f in os.listdir(scratch_folder(spark)) if f.startswith("files-")}
        seen.append((name, len(held - before)))
        return path

    before = set(os.listdir(scratch_folder(spark))) if os.path.isdir(scratch_folder(spark)) else set()
    monkeypatch.setattr(registry, "delivered", noted)
    whole = sorted(registry.queries()["ingest_csv"](spark, SF).collect())
    assert [name for name, _ in seen].count("visit") == 1
    assert max(held for _, held in seen) <= registry.INGESTED_TOGETHER
    assert not {f for f in os.listdir(scratch_folder(spark)) if f.startswith("files-")} - before
    monkeypatch.setattr(registry, "SLICE_BYTES", 60_000)  # of some 150,000
    sliced = sorted(registry.queries()["ingest_csv"](spark, SF).collect())
    assert sliced == whole and len(whole) == len(TABLES)
    assert [name for name, _ in seen].count("visit") > 2 and [name for name, _ in seen].count("doctor_schedule") == 2
