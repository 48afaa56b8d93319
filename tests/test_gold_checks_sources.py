from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import checks, dims, facts
from pulsegrid.plans.views import VIEWS, view
from pulsegrid.plans.warehouse import Warehouse, run_pipeline
from pulsegrid.sources import adapter
from pulsegrid.sources import tables as T

from .conftest import SF


def test_fixed_dimensions(spark):
    tables = {"dim_date": dims.dim_date(spark), "dim_time": dims.dim_time(spark), "dim_condition_category": dims.dim_condition_category(spark), "dim_drug_class": dims.dim_drug_class(spark), "dim_metric": dims.dim_metric(spark)}
    assert {r.status for r in checks.check_counts(tables).collect()} == {"ok"}
    more = tables | {"dim_condition": dims.dim_condition(spark), "dim_medication": dims.dim_medication(spark)}
    assert {(r.value, r.status) for r in checks.check_foreign_keys(more).collect()} == {(0.0, "ok")}
    holidays = {str(r.date) for r in tables["dim_date"].filter("is_holiday AND year = 2024").collect()}
    assert holidays == {"2024-01-01", "2024-05-27", "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25"}
    assert tables["dim_time"].filter("time_key = 2359").first().time_str == "23:59"


def test_labs_and_fills_keep_one_row_of_a_key(spark):
    labs = spark.createDataFrame([("M1", "LDL", 1.0, "u", 0.0, 2.0, False, "2024-01-01", "a", "1"), ("M1", "LDL", 3.0, "u", 0.0, 2.0, True, "2024-01-01", "b", "2"), ("M2", "TSH", 1.0, "u", None, None, None, "2024-01-01", "a", "3")], "patient_id string, test_code string, value double, unit string, reference_low double, reference_high double, is_abnormal boolean, d string, batch_date string, observation_id string").withColumn("test_date", F.to_date("d"))
    bridge = spark.createDataFrame([("person", "hospital_mrn", "M1")], "patient_key string, identifier_type string, identifier_value string")
    out = {r.lab_test_name: r for r in facts.fact_lab_result(labs, bridge, dims.dim_condition(spark)).collect()}
    assert out["LDL"].result_value == 3.0 and out["LDL"].condition_key is not None and out["TSH"].condition_key is None and out["TSH"].patient_key is not None
    fills = spark.createDataFrame([("1", "p", "0", "Metformin 500mg", "2024-01-02", 30, 0, "x"), ("1", "p", "0", "Metformin 500mg", "2024-01-01", 30, 0, "x"), ("2", "p", "68180-0512", "Unknown", "bad", 30, 1, "x"), ("3", "p", "0", "Other", None, 1, 1, "x")], "rx_id string, pharmacy_patient_id string, ndc_code string, drug_name string, fill_date string, days_supply int, refill_number int, status string")
    got = sorted(((r.date_key, r.medication_key is not None) for r in facts.fact_prescription_fill(fills, dims.dim_medication(spark)).collect()), key=str)
    assert got == [(20240101, True), (None, False), (None, True)]


def test_unknown_accounts_are_not_one_patient(spark):
    bridge = spark.createDataFrame([(None, "device_account_id", "a"), (None, "device_account_id", "b"), ("person", "device_account_id", "c")], "patient_key string, identifier_type string, identifier_value string")
    r = spark.createDataFrame([("a",), ("b",), ("c",)], "device_account_id string")
    assert facts.with_patient(r, bridge).select("patient_key").distinct().count() == 3


def test_pipeline_and_checks(spark, folder):
    gold = run_pipeline(spark, SF, folder)
    assert {r.status for r in checks.check_grain(gold).collect()} == {"ok"}
    assert {r.status for r in checks.check_not_null({k: v for k, v in gold.items() if k != "fact_vital_daily_summary"}).collect()} == {"ok"}
    assert checks.check_personal_columns(spark, gold).isEmpty()
    assert checks.check_personal_columns(spark, {"t": spark.createDataFrame([("a",)], "Email string")}).first().object == "t.Email"
    assert {r.status for r in checks.summary_invariants(gold["fact_vital_daily_summary"]).collect()} == {"ok"}
    for name in VIEWS:
        assert view(spark, name, gold).limit(1).collect() is not None
    w = Warehouse(spark, SF)
    assert gold["fact_vital_reading"].count() == w.readings.filter("is_valid").count()


def test_tables(spark, folder):
    assert T.read_table(spark, f"{folder}/none") is None
    assert T.or_empty(None, spark, "a int").columns == ["a"]
    T.overwrite(spark.createDataFrame([(1,)], "a int"), f"{folder}/t")
    T.append(spark.createDataFrame([(2, "x")], "a int, b string"), f"{folder}/t")
    assert sorted(tuple(r) for r in T.read_table(spark, f"{folder}/t").collect()) == [(1, None), (2, "x")]
    T.overwrite(spark.createDataFrame([(3,)], "a int"), f"{folder}/t")
    assert [tuple(r) for r in T.read_table(spark, f"{folder}/t").collect()] == [(3,)]
    with open(f"{folder}/x.csv", "w") as f:
        f.write("a,b\n1,x\nbad,y\n")
    assert [tuple(r) for r in T.read_csv(spark, f"{folder}/x.csv", "a int, b string").collect()] == [(1, "x"), (None, "y")]
    bronze = adapter.bronze(adapter.load(spark, SF, "events"))
    T.overwrite(bronze, f"{folder}/bronze", ["ingestion_date", "ingestion_hour"])
    again = T.replay(spark, f"{folder}/bronze", "2024-01-15", adapter.to_silver)
    assert again.agg(F.min(F.to_date("ingestion_timestamp"))).first()[0].isoformat() >= "2024-01-15"
    assert T.compact(bronze, 2, ["kafka_offset"]).rdd.getNumPartitions() <= 2


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    now = F.lit("2024-01-01 03:00:00").cast("timestamp")
    got = {r.table: (r.hours, r.status) for r in T.freshness({"a": (df, "t"), "b": (df, "t"), "c": (df.limit(0), "t")}, {"a": 4, "b": 1, "c": 1}, now).collect()}
    assert got == {"a": (3.0, "ok"), "b": (3.0, "stale"), "c": (None, "stale")}


def test_jdbc_export(spark, folder):
    url = f"jdbc:derby:{folder}/db;create=true"
    good, bad = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    result = T.export_jdbc({"fact_x": good, "dim_bad": bad, "dim_y": good}, url, props, partitions={"fact_x": (2, "k")})
    assert result["fact_x"] == result["dim_y"] == "ok" and result["dim_bad"].startswith("failed") and list(result)[-1] == "fact_x"
    assert T.export_jdbc({"fact_x": good, "dim_y": good}, url, props, only=["dim_y"]) == {"dim_y": "ok"}
    assert spark.read.jdbc(url, "dim_y", properties=props).count() == 2


@pytest.mark.parametrize("rows, want", [([(1, None), (2, "x")], 1), ([], 0)])
def test_personal_values(spark, rows, want):
    df = spark.createDataFrame([(k, f"mail a@b.com {v}" if v else v) for k, v in rows], "k int, v string")
    got = {r.object: int(r.value) for r in checks.personal_values(df, "t").collect()}
    assert got == {"t.v email": want, "t.v phone": 0, "t.v ssn": 0}


def test_registered_checks_cover_what_is_declared(spark):
    from pulsegrid.plans.queries import QUERIES

    seen = {n: {r.object for r in QUERIES[n](spark, SF).collect()} for n in ("o1_gold_row_counts", "o2_gold_foreign_keys", "o3_gold_not_null", "o5_gold_grain")}
    assert seen["o1_gold_row_counts"] == {*Warehouse.GOLD, *checks.EXPECTED_COUNTS}
    assert seen["o2_gold_foreign_keys"] == {f"{c}.{k} -> {p}" for c, k, p in checks.FOREIGN_KEYS}
    assert seen["o3_gold_not_null"] == {f"{t}.{c}" for t, cols in checks.NOT_NULL.items() for c in cols}
    assert seen["o5_gold_grain"] == set(checks.GRAINS)
