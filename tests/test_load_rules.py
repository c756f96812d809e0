"""One good row and one row breaking each rule, with the exact reason expected."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.operators.load import validated_load
from carelake.schemas import BY_NAME, TABLES

GOOD = {
    "diagnosis": dict(diagnosis_code="D001", diagnosis_name="Cold", diagnosis_category="Respiratory", severity_level="Mild"),
    "medical_procedure": dict(procedure_code="P001", procedure_name="Scan", procedure_category="Radiology",
                              expected_amount="100.00", complexity_score="3"),
    "drug": dict(drug_id="DR001", drug_name="A", generic_name="a", manufacturer="M", drug_category="Any", unit_amount="5.5"),
    "hospital": dict(hospital_id="H001", hospital_name="One", hospital_type="Private", governorate="Cairo",
                     district="El Arab", total_beds="10", icu_capacity="2", longitude="32.3", latitude="31.2"),
    "department": dict(department_id="DEPT0001", hospital_id="H001", department_name="ICU", floor_number="1",
                       manager_phone="0101"),
    "doctor": dict(doctor_id="DOC0001", hospital_id="H001", department_id="DEPT0001", first_name="A", last_name="B",
                   specialty="S", years_experience="5", employment_status="Active"),
    "doctor_schedule": dict(schedule_id="S1", doctor_id="DOC0001", shift_date="2025-01-05", shift_start="08:00",
                            shift_end="14:00"),
    "bed": dict(bed_id="B1", hospital_id="H001", department_id="DEPT0001", bed_number="1", bed_type="ICU",
                availability_status="Occupied"),
    "icu_status": dict(icu_status_id="I1", hospital_id="H001", occupied_beds="1", available_beds="2",
                       update_time="2025-01-05 10:00:00"),
    "patient": dict(patient_id="PAT1", national_id="29001019876543", first_name="A", last_name="B", gender="Male",
                    birth_date="1983-07-20", blood_type="A+"),
    "drug_inventory": dict(inventory_id="V1", hospital_id="H001", drug_id="DR001", quantity_available="5",
                           reorder_level="2", expiration_date="2026-01-01"),
    "drug_transaction": dict(transaction_id="T1", drug_id="DR001", hospital_id="H001", transaction_type="Purchase",
                             quantity="4", transaction_date="2025-01-01"),
    "visit": dict(visit_id="VIS1", patient_id="PAT1", hospital_id="H001", doctor_id="DOC0001", department_id="DEPT0001",
                  visit_date="2025-02-01", visit_type="Emergency", diagnosis_code="D001", visit_status="Completed",
                  waiting_time="10", total_amount="99.995"),
    "medical_record": dict(record_id="R1", visit_id="VIS1", follow_up_required="Yes"),
    "visit_procedure": dict(visit_procedure_id="VP1", visit_id="VIS1", procedure_code="P001", procedure_amount="120",
                            procedure_date="2025-02-01"),
    "prescription": dict(prescription_id="RX1", visit_id="VIS1", doctor_id="DOC0001", prescription_date="2025-02-01"),
    "prescription_item": dict(prescription_item_id="RI1", prescription_id="RX1", drug_id="DR001", dosage="5mg",
                              frequency="Once daily", duration_days="7", quantity="7"),
    "referral": dict(referral_id="REF1", patient_id="PAT1", from_hospital_id="H001", to_hospital_id="H002",
                     referral_reason="x", referral_date="2025-02-01", referral_status="Pending"),
    "claim": dict(claim_id="C1", patient_id="PAT1", visit_id="VIS1", hospital_id="H001", claim_date="2025-02-02",
                  claim_amount="50", approved_amount="40", claim_status="Approved"),
    "claim_item": dict(claim_item_id="CI1", claim_id="C1", procedure_code="P001", item_amount="50.25", quantity="1"),
    "claim_approval": dict(approval_id="A1", claim_id="C1", reviewed_by="R", approval_status="Approved",
                           approval_date="2025-02-03"),
    "patient_feedback": dict(feedback_id="F1", patient_id="PAT1", hospital_id="H001", doctor_id="DOC0001", rating="4",
                             feedback_date="2025-02-04"),
}

# table, changed columns, reasons expected (none: the row is accepted)
CASES = [
    ("diagnosis", {"diagnosis_category": "Magic"}, ["domain:diagnosis_category"]),
    ("diagnosis", {"severity_level": "Huge"}, ["domain:severity_level"]),
    ("diagnosis", {"severity_level": "mILD  "}, []),
    ("diagnosis", {"diagnosis_code": None}, ["null:diagnosis_code"]),
    ("diagnosis", {"diagnosis_name": None, "severity_level": None}, ["null:diagnosis_name", "null:severity_level"]),
    ("diagnosis", {"diagnosis_code": "D0001"}, ["length:diagnosis_code"]),
    ("medical_procedure", {"expected_amount": "EGP1,200.50"}, []),
    ("medical_procedure", {"expected_amount": "n/a"}, ["cast:expected_amount"]),
    ("medical_procedure", {"expected_amount": "1e3"}, ["cast:expected_amount"]),
    ("medical_procedure", {"expected_amount": "-1"}, ["range:expected_amount"]),
    ("medical_procedure", {"expected_amount": "123456789.00"}, ["cast:expected_amount"]),
    ("medical_procedure", {"complexity_score": "6"}, ["range:complexity_score"]),
    ("medical_procedure", {"complexity_score": "0"}, ["range:complexity_score"]),
    ("medical_procedure", {"procedure_category": "General Procedure"}, ["domain:procedure_category"]),
    ("drug", {"drug_category": "Whatever"}, []),
    ("drug", {"unit_amount": "-0.01"}, ["range:unit_amount"]),
    ("hospital", {"governorate": None}, []),
    ("hospital", {"total_beds": "12.7"}, ["cast:total_beds"]),
    ("hospital", {"total_beds": "0"}, ["range:total_beds"]),
    ("hospital", {"icu_capacity": ""}, ["null:icu_capacity"]),
    ("hospital", {"latitude": "x"}, []),
    ("hospital", {"district": "Elsewhere"}, ["domain:district"]),
    ("department", {"hospital_id": "H999"}, ["fk:hospital"]),
    ("department", {"hospital_id": "h001 "}, []),
    ("department", {"floor_number": "4"}, ["domain:floor_number"]),
    ("department", {"floor_number": "2.0", "manager_phone": "none"}, []),
    ("doctor", {"years_experience": "39"}, ["range:years_experience"]),
    ("doctor", {"department_id": "DEPT0009"}, ["fk:department"]),
    ("doctor", {"hospital_id": "H999"}, []),
    ("doctor", {"employment_status": "Retired"}, ["domain:employment_status"]),
    ("doctor_schedule", {"shift_date": "05/01/2025"}, ["cast:shift_date"]),
    ("doctor_schedule", {"shift_date": "2025"}, ["cast:shift_date"]),
    ("doctor_schedule", {"shift_start": "09:00"}, ["domain:shift_start"]),
    ("bed", {"bed_type": "Sofa"}, ["domain:bed_type"]),
    ("icu_status", {"occupied_beds": "-1"}, ["range:occupied_beds"]),
    ("icu_status", {"update_time": "later"}, ["cast:update_time"]),
    ("patient", {"blood_type": None}, []),
    ("patient", {"blood_type": "C+"}, ["domain:blood_type"]),
    ("patient", {"national_id": "abc"}, ["cast:national_id"]),
    ("patient", {"phone": "abc"}, ["cast:phone"]),
    ("patient", {"birth_date": "1983-02-30"}, ["cast:birth_date"]),
    ("drug_inventory", {"expiration_date": "soon"}, []),
    ("drug_inventory", {"drug_id": "DR999"}, ["fk:drug"]),
    ("drug_transaction", {"quantity": "0"}, ["range:quantity"]),
    ("drug_transaction", {"transaction_type": "Gift"}, ["domain:transaction_type"]),
    ("visit", {"waiting_time": "soon", "total_amount": "much"}, []),
    ("visit", {"patient_id": "PAT9", "doctor_id": "DOC9", "diagnosis_code": "D9"}, ["fk:patient", "fk:doctor", "fk:diagnosis"]),
    ("medical_record", {"follow_up_required": "Hm"}, ["domain:follow_up_required"]),
    ("visit_procedure", {"procedure_code": "P999"}, ["fk:procedure"]),
    ("prescription", {"visit_id": "VIS9"}, ["fk:visit"]),
    ("prescription_item", {"duration_days": "2"}, ["range:duration_days"]),
    ("prescription_item", {"duration_days": "91"}, ["range:duration_days"]),
    ("prescription_item", {"frequency": "Hourly"}, ["domain:frequency"]),
    ("referral", {"to_hospital_id": "h001"}, ["check:from_to"]),
    ("referral", {"to_hospital_id": "H999"}, ["fk:to_hospital"]),
    ("claim", {"approved_amount": "?"}, []),
    ("claim", {"claim_amount": None}, ["null:claim_amount"]),
    ("claim_item", {"drug_id": "DR001"}, ["check:xor"]),
    ("claim_item", {"procedure_code": ""}, ["check:xor"]),
    ("claim_item", {"procedure_code": "", "drug_id": "DR001"}, []),
    ("claim_item", {"procedure_code": "P999"}, ["fk:procedure"]),
    ("claim_item", {"item_amount": None, "quantity": None}, []),
    ("claim_item", {"quantity": "0"}, ["range:quantity"]),
    ("claim_approval", {"approval_date": "?"}, []),
    ("claim_approval", {"approval_status": "Lost"}, ["domain:approval_status"]),
    ("patient_feedback", {"rating": "6"}, ["range:rating"]),
]

ONE_PER_PARENT = ("medical_record", "claim", "claim_approval", "drug_inventory")


@pytest.fixture(scope="module")
def parents(core_of):
    tables = {name: [row] for name, row in GOOD.items()}
    tables["hospital"] = [GOOD["hospital"], {**GOOD["hospital"], "hospital_id": "H002"}]
    return core_of(tables)


def load(staged, parents, name, rows, **options):
    # the table itself starts empty; its parents hold the good rows
    empty = parents.replaced(**{name: parents[name].limit(0)})
    return validated_load(staged(name, rows), BY_NAME[name], empty, **options)


@pytest.mark.parametrize("name", [t.name for t in TABLES])
def test_rules_of_each_table(staged, parents, name):
    """Every case of a table in one batch: each row gets exactly its own reasons."""
    cases = [(changes, reasons) for table, changes, reasons in CASES if table == name]
    key = BY_NAME[name].key
    rows, expected_bad = [dict(GOOD[name])], {}
    for number, (changes, reasons) in enumerate(cases):
        row = {**GOOD[name], **changes}
        if key not in changes:
            row[key] = f"K{number}"
        if name == "patient" and "national_id" not in changes:
            row["national_id"] = str(10**12 + number)
        if name in ("medical_record", "claim") or name == "claim_approval" or name == "drug_inventory":
            continue  # one row per parent key: tested one by one below
        rows.append(row)
        if reasons:
            expected_bad[row[key]] = reasons
    result = load(staged, parents, name, rows)
    got = {r.source_key: r.reasons for r in result.quarantined.collect()}
    assert got == expected_bad
    assert result.accepted.count() == len(rows) - len(expected_bad)
    assert not result.failed


@pytest.mark.parametrize(
    "name,changes,reasons",
    [c for c in CASES if c[0] in ONE_PER_PARENT],
)
def test_rules_of_tables_with_unique_parents(staged, parents, name, changes, reasons):
    result = load(staged, parents, name, [{**GOOD[name], **changes}])
    assert [r.reasons for r in result.quarantined.collect()] == ([reasons] if reasons else [])
    assert result.accepted.count() == (0 if reasons else 1)


def test_values_are_brought_to_core_form(staged, parents):
    row = load(staged, parents, "medical_procedure", [{**GOOD["medical_procedure"], "expected_amount": "egp 1,200.505"}])
    assert row.accepted.first().expected_amount == Decimal("1200.51")
    row = load(staged, parents, "diagnosis", [{**GOOD["diagnosis"], "diagnosis_code": "d007 ", "severity_level": "mild "}])
    assert row.accepted.first()[:] == ("D007", "Cold", "Respiratory", "Mild")
    row = load(staged, parents, "hospital", [{**GOOD["hospital"], "governorate": None, "latitude": "x"}]).accepted.first()
    assert (row.governorate, row.latitude, row.longitude) == ("Port Said", None, Decimal("32.300000"))
    row = load(staged, parents, "department", [{**GOOD["department"], "floor_number": "2.0"}]).accepted.first()
    assert (row.floor_number, row.manager_phone) == ("2", "101")
    assert load(staged, parents, "visit", [GOOD["visit"]]).accepted.first().total_amount == Decimal("100.00")
    assert load(staged, parents, "visit", [{**GOOD["visit"], "waiting_time": "soon"}]).accepted.first().waiting_time is None


def test_raw_row_is_kept_with_its_reasons(staged, parents):
    bad = load(staged, parents, "drug", [{**GOOD["drug"], "unit_amount": "n/a"}]).quarantined.first()
    assert bad.target_table == "ref.drug"
    assert bad.source_key == "DR001"
    assert '"unit_amount":"n/a"' in bad.raw_data


@pytest.mark.parametrize(
    "name,other",
    [("patient", {"patient_id": "PAT2"}), ("medical_record", {"record_id": "R2"}), ("claim", {"claim_id": "C2"}),
     ("claim_approval", {"approval_id": "A2"}), ("drug_inventory", {"inventory_id": "V2"})],
)
def test_second_key_taken_in_core(staged, parents, name, other):
    """Another row already in core holds the unique value."""
    result = validated_load(staged(name, [{**GOOD[name], **other}]), BY_NAME[name], parents)
    code = "unique:" + "+".join(BY_NAME[name].uniques[0])
    assert [r.reasons for r in result.quarantined.collect()] == [[code]]


def test_duplicate_keys_fail_the_table_or_keep_the_first(staged, parents):
    rows = [GOOD["drug"], {**GOOD["drug"], "drug_id": "dr001 ", "drug_name": "Z"}, {**GOOD["drug"], "drug_id": "DR002"}]
    result = load(staged, parents, "drug", rows, on_duplicate="fail")
    assert result.failed and result.accepted.count() == 0
    assert [(r.source_key, r.reasons) for r in result.quarantined.collect()] == [(None, ["duplicate:drug_id"])]
    result = load(staged, parents, "drug", rows, on_duplicate="first")
    assert sorted((r.drug_id, r.drug_name) for r in result.accepted.collect()) == [("DR001", "A"), ("DR002", "A")]
    assert [(r.source_key, r.reasons) for r in result.quarantined.collect()] == [("dr001 ", ["duplicate:drug_id"])]


def test_many_identical_copies(staged, parents):
    """A key that is most of the batch, all copies alike: one is kept, the others reported."""
    rows = [GOOD["drug"]] * 500 + [{**GOOD["drug"], "drug_id": f"D{i}"} for i in range(200)]
    result = load(staged, parents, "drug", rows, on_duplicate="first")
    assert result.accepted.count() == 201
    assert result.quarantined.filter(F.array_contains("reasons", "duplicate:drug_id")).count() == 499


def test_same_second_key_twice_in_a_batch(staged, parents):
    rows = [GOOD["patient"], {**GOOD["patient"], "patient_id": "PAT2"}]
    assert load(staged, parents, "patient", rows).failed
    kept = load(staged, parents, "patient", rows, on_duplicate="first")
    assert [r.patient_id for r in kept.accepted.collect()] == ["PAT1"]
    assert [r.reasons for r in kept.quarantined.collect()] == [["unique:national_id"]]


def test_rerun_adds_nothing(staged, parents):
    result = validated_load(staged("drug", [{**GOOD["drug"], "drug_id": "dr001"}]), BY_NAME["drug"], parents)
    counts = result.counts().first()
    assert (counts.accepted, counts.rejected, counts.known) == (0, 0, 1)
