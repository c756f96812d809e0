"""A small batch against large stored tables reads them where they lie; a batch of any size is not shuffled."""

from __future__ import annotations

import re

from test_load_rules import GOOD

from carelake.operators.load import judge, judged, key_findings, numbered_text, with_core_values
from carelake.plans.session import written
from carelake.schemas import BY_NAME
from carelake.core import Core


def test_no_core_table_is_shuffled_for_a_few_claims(spark, staged, tmp_path):
    table = BY_NAME["claim"]
    keys = {"visit": "visit_id", "patient": "patient_id", "hospital": "hospital_id"}
    stored = {}
    for name, key in keys.items():
        spark.range(60_000).selectExpr(f"concat('{name[:3].upper()}', id) AS {key}").write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    own = spark.range(60_000).selectExpr("concat('C', id) AS claim_id", "concat('VIS', id) AS visit_id")
    own.write.parquet(f"{tmp_path}/claim")
    stored["claim"] = spark.read.parquet(f"{tmp_path}/claim")
    batch = staged("claim", [
        {**GOOD["claim"], "claim_id": f"N{i}", "visit_id": f"VIS{i}", "patient_id": f"PAT{i}", "hospital_id": f"HOS{i}"} for i in range(5)
    ])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        text = written(numbered_text(batch, table), "batch")
        found = key_findings(with_core_values(text, table), table, Core(spark, stored))
        plan = found._jdf.queryExecution().executedPlan().toString()
        outcome = {r.outcome for r in judged(batch, table, Core(spark, stored)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "LeftSemi" in plan
    for semi in re.findall(r"(\w+) \[[^\n]*LeftSemi", plan):
        assert semi == "BroadcastHashJoin"
    assert outcome == {"rejected"}  # their visits have claims already


def test_the_batch_is_not_shuffled(spark, staged, core_of):
    """Whatever its size, if few of its keys are amiss: each join meets a broadcast of those."""
    table = BY_NAME["claim"]
    parents = {"visit": "visit_id", "patient": "patient_id", "hospital": "hospital_id"}
    core = Core(spark, {
        **{name: spark.range(3000).selectExpr(f"concat('{name[:3].upper()}', id) AS {key}") for name, key in parents.items()},
        "claim": spark.range(20).selectExpr("concat('C', id) AS claim_id", "concat('VIS', id) AS visit_id"),
    })
    rows = [{**GOOD["claim"], "claim_id": f"C{i}", "visit_id": f"VIS{i + 10}", "patient_id": f"PAT{i}", "hospital_id": "HOS5"} for i in range(3000)]
    found = judge(staged("claim", rows), table, core)
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    got = {}
    for row in found.rows.collect():
        got.setdefault(("known" if row.outcome == "known" else tuple(row.reasons)), []).append(row.claim_id)
    assert found.staged == 3000 and found.kinds == {"missing:visit_id", "known", "taken:visit_id"}
    assert {k: len(v) for k, v in got.items()} == {"known": 20, ("fk:visit",): 10, (): 2970}


def test_nothing_is_joined_for_a_clean_batch(spark, staged, core_of):
    core = core_of({name: [GOOD[name]] for name in ("visit", "patient", "hospital")})
    found = judge(staged("claim", [GOOD["claim"]]), BY_NAME["claim"], core)
    assert "Join" not in found.rows._jdf.queryExecution().executedPlan().toString()
    assert [r.outcome for r in found.rows.collect()] == ["good"]
