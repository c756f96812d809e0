"""Identifiers keep every digit, however long the numbers get."""

from __future__ import annotations

from conftest import SF
from pyspark.sql import functions as F

from carelake.functions.text import numbered
from carelake.operators.commands import next_ids
from carelake.sources.driver_tables import VIEWS, driver_core


def test_ten_thousand_suppliers_have_different_ids(spark):
    many = spark.range(10_001).select(
        F.col("id").alias("s_suppkey"), F.lit("x").alias("s_name"), (F.col("id") % 25).cast("int").alias("s_nationkey"),
        F.lit(0.0).alias("s_acctbal"),
    )
    doctors = spark.sql(VIEWS["doctor"], supplier=many)
    assert doctors.select("doctor_id").distinct().count() == 10_001
    assert {r.doctor_id for r in doctors.filter("doctor_no IN (0, 999, 9999)").collect()} == {"DOC0001", "DOC1000", "DOC10000"}


def test_every_part_is_a_diagnosis(spark):
    core = driver_core(spark, SF)
    assert core["diagnosis"].count() == core["part"].count()
    assert core["visit"].join(core["diagnosis"], "diagnosis_code", "left_anti").isEmpty()


def test_ids_go_on_after_the_widest(spark):
    taken = spark.createDataFrame([("DT9999999",), ("DT0000001",), ("other",)], "transaction_id string")
    rows = spark.createDataFrame([(3,), (1,), (2,)], "seq int")
    found = next_ids(rows, ["seq"], taken, "transaction_id", "DT", 7).orderBy("seq").collect()
    assert [r.transaction_id for r in found] == ["DT10000000", "DT10000001", "DT10000002"]
    again = taken.union(spark.createDataFrame([("DT10000002",)], "transaction_id string"))
    assert next_ids(rows.filter("seq = 1"), ["seq"], again, "transaction_id", "DT", 7).first().transaction_id == "DT10000003"


def test_numbers_are_padded_and_never_cut(spark):
    row = spark.range(1).select(numbered("A", F.lit(7), 3).alias("a"), numbered("A", F.lit(12345), 3).alias("b")).first()
    assert (row.a, row.b) == ("A007", "A12345")
