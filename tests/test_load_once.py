"""Staged text is read once, when the batch is written; what is rejected still shows the text as delivered."""

from __future__ import annotations

import json

from test_load_rules import GOOD

from carelake.operators.load import validated_load
from carelake.schemas import BY_NAME


def test_later_steps_parse_no_text(spark, staged, core_of):
    parents = {name: [GOOD[name]] for name in ("drug", "hospital")}
    result = validated_load(staged("drug_transaction", [GOOD["drug_transaction"]]), BY_NAME["drug_transaction"], core_of(parents))
    assert result.accepted.count() == 1
    for rows in (result.accepted, result.quarantined):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan and "array_compact" not in plan and "upper(" not in plan
    read = result.accepted._jdf.queryExecution().executedPlan().toString()
    assert "s_quantity" not in read  # the accepted rows need no text


def test_rejected_rows_show_their_text(staged, core_of):
    table = BY_NAME["hospital"]
    odd = {**GOOD["hospital"], "hospital_id": "h002  ", "governorate": None, "district": "el arab ", "total_beds": " 012", "icu_capacity": "n/a",
           "longitude": "32.3", "latitude": "east", "phone": "", "manager_name": " A, \"b\" "}
    same = {**GOOD["hospital"], "hospital_id": "H003", "governorate": "Port Said", "total_beds": "0", "longitude": "32.300000"}
    result = validated_load(staged("hospital", [odd, same]), table, core_of({}))
    rows = {r.source_key: r for r in result.quarantined.collect()}
    assert rows["h002  "].reasons == ["cast:icu_capacity"] and rows["H003"].reasons == ["range:total_beds"]
    for key, given in (("h002  ", odd), ("H003", same)):
        assert json.loads(rows[key].raw_data) == {c: given.get(c) or None for c in table.column_names}
    assert [r.reasons for r in result.judged.orderBy("row_no").collect()] == [["cast:icu_capacity"], ["range:total_beds"]]


def test_reasons_keep_their_order(staged, core_of):
    table = BY_NAME["claim_item"]
    row = {**GOOD["claim_item"], "claim_id": "C9", "drug_id": "DR9", "item_amount": "-1"}
    result = validated_load(staged("claim_item", [row, GOOD["claim_item"]]), table, core_of({n: [GOOD[n]] for n in ("claim", "medical_procedure", "drug")}))
    assert [r.reasons for r in result.quarantined.collect()] == [["range:item_amount", "check:xor", "fk:claim", "fk:drug"]]
    assert result.accepted.count() == 1 and result.judged.filter("size(reasons) = 0").count() == 1
