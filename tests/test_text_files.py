from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from carelake.operators.load import load_files, validated_load
from carelake.schemas import BY_NAME
from carelake.sources.text_files import SOURCE, read_csv, read_tsv, readable, unreadable

NOW = datetime(2025, 1, 1)


@pytest.fixture()
def deliver(tmp_path):
    def write(name: str, text: str) -> str:
        path = tmp_path / name
        path.write_bytes(text.encode("utf-8"))
        return str(path)

    return write


def test_columns_are_bound_by_header(spark, deliver, core_of):
    """Latitude is delivered before longitude; a positional load would swap them."""
    path = deliver(
        "hospitals.csv",
        "hospital_id,hospital_name,hospital_type,governorate,district,phone,total_beds,icu_capacity,latitude,longitude\n"
        "H001,First,Private,,El Arab,1,10,2,31.25,32.28\n",
    )
    staged = readable(read_csv(spark, path, BY_NAME["hospital"], NOW))
    row = validated_load(staged, BY_NAME["hospital"], core_of({})).accepted.first()
    assert (row.latitude, row.longitude) == (Decimal("31.250000"), Decimal("32.280000"))
    assert row.governorate == "Port Said" and row.manager_name is None
    assert staged.first()[SOURCE[1]].endswith("hospitals.csv")
    assert staged.first()[SOURCE[0]] == NOW


def test_renamed_headers_and_quoted_commas(spark, deliver, core_of):
    path = deliver(
        "procedures.csv",
        "procedure_code,procedure_name,procedure_category,expected_cost,complexity_score\n"
        'P001,"Panel, basic ""A"" ±",Laboratory,"1,150",1\n',
    )
    row = load_files(spark, path, BY_NAME["medical_procedure"], core_of({}), NOW).accepted.first()
    assert row.procedure_name == 'Panel, basic "A" ±'
    assert row.expected_amount == Decimal("1150.00")


def test_tab_separated_without_quoting(spark, deliver, core_of):
    path = deliver(
        "patients.txt",
        "patient_id\tnational_id\tfirst_name\tlast_name\tgender\tbirth_date\tstreet\n"
        'PAT1\t290010198765432\tA "x"\tB, C\tmale\t1983-07-20\t\n',
    )
    staged = readable(read_tsv(spark, path, BY_NAME["patient"], NOW))
    row = validated_load(staged, BY_NAME["patient"], core_of({})).accepted.first()
    assert (row.first_name, row.last_name, row.gender, row.street) == ('A "x"', "B, C", "Male", None)
    assert row.national_id == Decimal("290010198765432")


def test_lines_with_wrong_field_count_are_quarantined(spark, deliver, core_of):
    path = deliver("drugs.csv", "drug_id,drug_name,generic_name,manufacturer,drug_category,unit_price\n"
                   "DR001,a,b,c,d,1.5\nDR002,a,b\nDR003,a,b,c,d,2,extra\n")
    staged = read_csv(spark, path, BY_NAME["drug"], NOW)
    assert readable(staged).count() == 1
    assert unreadable(staged, BY_NAME["drug"]).count() == 2
    result = load_files(spark, path, BY_NAME["drug"], core_of({}), NOW)
    assert [r.drug_id for r in result.accepted.collect()] == ["DR001"]
    assert [r.reasons for r in result.quarantined.collect()] == [["parse:fields"]] * 2


def test_files_with_different_column_order(spark, deliver):
    first = deliver("a.csv", "diagnosis_code,diagnosis_name,diagnosis_category,severity_level\nD1,Cold,ENT,Mild\n")
    second = deliver("b.csv", "severity_level,diagnosis_code,diagnosis_category,diagnosis_name\r\nSevere,D2,ENT,Flu\r\n")
    rows = readable(read_csv(spark, [first, second], BY_NAME["diagnosis"], NOW)).orderBy("diagnosis_code").collect()
    assert [tuple(r)[:4] for r in rows] == [("D1", "Cold", "ENT", "Mild"), ("D2", "Flu", "ENT", "Severe")]


def test_repeated_delivery_is_a_duplicate(spark, deliver, core_of):
    path = deliver("d.csv", "diagnosis_code,diagnosis_name,diagnosis_category,severity_level\nD1,Cold,ENT,Mild\n")
    assert load_files(spark, [path, path], BY_NAME["diagnosis"], core_of({}), NOW).failed
    kept = load_files(spark, [path, path], BY_NAME["diagnosis"], core_of({}), NOW, on_duplicate="first")
    assert kept.accepted.count() == 1
