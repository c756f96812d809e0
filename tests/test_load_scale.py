"""What a load shuffles, writes and leaves behind."""

from __future__ import annotations

import os
import re

from test_load_rules import GOOD

from carelake.operators import commands
from carelake.operators.load import key_findings, load_all, numbered_text, validated_load, with_core_values
from carelake.plans.session import scratch_folder, written
from carelake.schemas import BY_NAME
from carelake.sources.store import CoreStore
from carelake.sources.text_files import read_csv, readable, write_delimited
from datetime import date, datetime

NOW = datetime(2025, 6, 1, 8)


def shuffled(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)


def test_own_keys_are_shuffled_as_hashes_and_once(spark, staged, core_of):
    table = BY_NAME["diagnosis"]
    batch = staged("diagnosis", [{**GOOD["diagnosis"], "diagnosis_code": f"D{i % 90}"} for i in range(100)])
    core = core_of({"diagnosis": [{**GOOD["diagnosis"], "diagnosis_code": f"D{i}"} for i in range(85, 95)]})
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    for k in limits:
        spark.conf.set(k, "-1")
    try:
        text = written(numbered_text(batch, table), "batch")
        found = key_findings(with_core_values(text, table), table, core)
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan.split("Initial Plan")[0]
    assert set(shuffled(final)) == {"key_hash"} and "ReusedExchange" in final
    assert {r.key_0 for r in rows if r.kind == "known"} == {f"D{i}" for i in range(85, 90)}
    assert [r.kind for r in rows if r.kind.startswith("repeat")] == ["repeat:diagnosis_code"]


def test_known_and_repeated_keys_by_value(staged, core_of):
    table = BY_NAME["diagnosis"]
    codes = ["D1", "d1 ", "D2", "D3"]
    batch = staged("diagnosis", [{**GOOD["diagnosis"], "diagnosis_code": c, "diagnosis_name": f"name {i}"} for i, c in enumerate(codes)])
    core = core_of({"diagnosis": [{**GOOD["diagnosis"], "diagnosis_code": c, "diagnosis_name": "old"} for c in ("D3", "D9")]})
    result = validated_load(batch, table, core, on_duplicate="first")
    assert sorted(r.diagnosis_code for r in result.accepted.collect()) == ["D1", "D2"]
    assert [tuple(r.reasons) for r in result.quarantined.collect()] == [("duplicate:diagnosis_code",)]
    assert result.judged.filter("outcome = 'known'").count() == 1


def test_intermediates_end_with_the_load_of_their_table(spark, staged, tmp_path):
    names, log = ("diagnosis", "medical_procedure", "drug"), []

    def delivery(name):
        def deliver():
            log.append(("delivered", name))
            return staged(name, [GOOD[name]])

        return deliver

    folder = scratch_folder(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    store = CoreStore(spark, f"{tmp_path}/core")
    load_all({n: delivery(n) for n in names}, store, NOW, side_by_side=1, done=lambda n: log.append(("loaded", n)))
    assert [kind for kind, _ in log] == ["delivered", "loaded"] * 3
    assert {n for _, n in log} == set(names)
    assert all(store.read(n).count() == 1 for n in names)
    assert not {f for f in set(os.listdir(folder)) - before if f.startswith(("staged-", "findings-"))}


def test_delivered_files_may_be_compressed(spark, staged, tmp_path):
    table = BY_NAME["diagnosis"]
    rows = staged("diagnosis", [{**GOOD["diagnosis"], "diagnosis_code": f"D{i}", "diagnosis_name": 'a, "b" '} for i in range(50)])
    write_delimited(rows, f"{tmp_path}/csv", codec="lz4")
    assert all(f.endswith(".csv.lz4") for f in os.listdir(f"{tmp_path}/csv") if f.startswith("part"))
    back = readable(read_csv(spark, f"{tmp_path}/csv", table, NOW)).select(*table.column_names)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_dispensing_carries_only_what_it_uses(spark, core_of, monkeypatch):
    seen = {}
    keep = commands.written

    def noted(df, label, *rest):
        seen.setdefault(label, []).append(df.columns)
        return keep(df, label, *rest)

    monkeypatch.setattr(commands, "written", noted)
    core = core_of({
        "drug_inventory": [{**GOOD["drug_inventory"], "inventory_id": f"I{i}", "hospital_id": "H001", "drug_id": f"DR00{i}",
                            "quantity_available": 5} for i in range(3)],
        "drug_transaction": [],
    })
    asked = spark.createDataFrame([(1, "H001", "DR001", 2, "n", "long text")],
                                  "seq bigint, hospital_id string, drug_id string, quantity int, performed_by string, source_id string")
    outcome = commands.dispense(core, asked, date(2025, 6, 1))
    left = {r.drug_id: r.quantity_available for r in commands.updated(core, outcome, "drug_inventory").collect()}
    assert left == {"DR000": 5, "DR001": 3, "DR002": 5}
    assert not any("source_id" in columns for found in seen.values() for columns in found)
    assert len(seen["changed-drug_inventory"]) == 1  # the changed rows are worked out once


def test_the_store_is_written_with_zstd(spark, staged, tmp_path):
    store = CoreStore(spark, f"{tmp_path}/core")
    load_all({"diagnosis": staged("diagnosis", [GOOD["diagnosis"], {**GOOD["diagnosis"], "diagnosis_code": None}])}, store, NOW)
    files = [f"{at}/{f}" for at, _, found in os.walk(tmp_path) for f in found if f.startswith("part")]
    assert files and all(".zstd." in f for f in files)
    assert store.read("diagnosis").count() == 1 and store.error_log().count() == 1
