from __future__ import annotations

import json

from pyspark.sql import functions as F

from pulsegrid.functions import keys as K
from pulsegrid.operators import parse, quality
from pulsegrid.sources import tables as T


def message(**kw):
    base = {"reading_id": "r1", "device_id": "SW-1", "device_type": "smartwatch", "user_device_account_id": "a", "metrics": {"heart_rate_bpm": 70}, "firmware_version": "1", "battery_pct": 50, "event_timestamp": "2024-01-01T00:00:00Z", "sync_timestamp": "2024-01-01T02:00:00Z"}
    return json.dumps(base | kw)


def bronze(spark, values):
    df = spark.createDataFrame([(v, "t", 0, k) for k, v in enumerate(values)], "value string, topic string, partition int, offset long")
    return T.to_bronze(df.withColumn("timestamp", F.lit("2024-01-01 05:06:07").cast("timestamp")), F.col("timestamp"))


def test_envelope(spark):
    df = bronze(spark, ["{}"])
    assert df.columns == T.BRONZE_COLUMNS
    row = df.first()
    assert (row.ingestion_date, row.ingestion_hour, row.kafka_offset) == ("2024-01-01", "05", 0)


def test_explosion_keeps_nulls_and_words(spark):
    values = [message(metrics={"heart_rate_bpm": None, "sleep_stage": "deep", "spo2_pct": 98.5}), message(reading_id="r2", metrics={}), message(reading_id="r3", metrics=None), "not json", message(reading_id="r4", battery_pct="x", event_timestamp="yesterday")]
    df = parse.explode_metrics(parse.parse_readings(bronze(spark, values)))
    got = {(r.reading_id, r.metric_name): (r.metric_value, r.metric_text) for r in df.collect()}
    assert got == {("r1", "heart_rate_bpm"): (None, None), ("r1", "sleep_stage"): (None, "deep"), ("r1", "spo2_pct"): (98.5, "98.5"), ("r4", "heart_rate_bpm"): (70.0, "70")}
    bad = df.filter("reading_id = 'r4'").first()
    assert bad.battery_pct is None and bad.event_timestamp is None


def test_validity_and_lateness(spark):
    rows = [("heart_rate_bpm", 30.0, 7200), ("heart_rate_bpm", 29.9, 7201), ("heart_rate_bpm", None, 0), ("new_metric", -5.0, 0), ("sleep_stage", 4.0, None)]
    df = spark.createDataFrame(rows, "metric_name string, metric_value double, lag int").withColumn("event_timestamp", F.timestamp_seconds(F.lit(0))).withColumn("sync_timestamp", F.timestamp_seconds("lag"))
    got = [(r.is_valid, r.is_late_arriving) for r in quality.flag_late(quality.flag_valid(df)).collect()]
    assert got == [(True, False), (False, True), (False, False), (True, False), (True, False)]
    bounds = spark.createDataFrame([(5.0, 1.0, None), (5.0, 1.0, 5.0), (None, 1.0, 5.0)], "v double, lo double, hi double")
    assert [r.in_normal_range for r in quality.flag_normal(bounds, "v", "lo", "hi").collect()] == [False, True, False]


def test_keys(spark):
    df = spark.createDataFrame([("a", None, "  Foo@X.com ", 2000), ("a", "b", "foo@x.com", None)], "a string, b string, e string, y int")
    r0, r1 = df.select(K.surrogate_key("a", "b").alias("k"), K.person_key("e").alias("p"), K.row_hash("a", "b").alias("h"), K.age_group("y", 2024).alias("g")).collect()
    assert r0.k is None and 0 < r1.k < 1 << 60 and r0.p == r1.p and r0.h != r1.h and (r0.g, r1.g) == ("18-34", "Unknown")
    ages = spark.createDataFrame([(y,) for y in (2007, 2006, 1990, 1989, 1975, 1974, 1960, 1959)], "y int").select(K.age_group("y", 2024).alias("g"))
    assert [r.g for r in ages.collect()] == ["0-17", "18-34", "18-34", "35-49", "35-49", "50-64", "50-64", "65+"]
    d = spark.createDataFrame([("00093-7123", "Metformin 500mg", "2024-02-29"), ("1", "", "bad")], "n string, d string, f string").select(K.drug_of_ndc("n").alias("n"), K.first_word("d").alias("w"), K.date_key_of_string("f").alias("k"))
    assert [tuple(r) for r in d.collect()] == [("metformin", "metformin", 20240229), (None, "", None)]


def test_changes(spark):
    after = {"rx_id": "1", "status": "new", "days_supply": 30}
    values = [json.dumps({"op": "c", "after": after, "ts_ms": 1}), json.dumps({"op": "d", "before": after, "after": None, "ts_ms": 2}), json.dumps({"op": "u", "after": None, "ts_ms": 3}), "{"]
    got = parse.parse_changes(bronze(spark, values)).collect()
    assert [(r.op, r.rx_id, r.ts_ms) for r in got] == [("c", "1", 1), ("d", "1", 2)]
    assert parse.parse_changes(bronze(spark, values), ("c", "u")).count() == 1


def test_clinical_batches(spark, folder):
    entries = [{"resource_type": "Condition", "code": "I10", "status": "active", "onset_date": "2020-01-02", "is_chronic": True}, {"resource_type": "MedicationStatement", "medication": "m", "dosage": "1", "status": "active", "start_date": "2020-01-01", "end_date": None}, {"resource_type": "Observation", "code": "LDL", "value": 3.5, "date": "bad"}]
    for day, email in (("2024-01-01", "Old@x.com"), ("2024-01-02", "new@x.com")):
        import os

        os.makedirs(f"{folder}/{day}")
        with open(f"{folder}/{day}/ehr_batch.json", "w") as f:
            json.dump({"batch_date": "wrong", "patients": [{"resource_type": "Bundle", "patient_id": "MRN1", "patient_email": email, "patient_birth_year": 1980, "entries": entries}]}, f, indent=1)
    patients = T.read_ehr(spark, f"{folder}/*/ehr_batch.json")
    assert sorted(r.batch_date for r in patients.collect()) == ["2024-01-01", "2024-01-02"]
    assert [tuple(r) for r in T.demographics(patients).collect()] == [("MRN1", "new@x.com", 1980)]
    c, m, lab = parse.conditions(patients).first(), parse.medications(patients).first(), parse.labs(patients).first()
    assert c.icd10_code == "I10" and str(c.onset_date) == "2020-01-02" and len(c.row_hash) == 64
    assert m.is_current and m.effective_end is None
    assert lab.value == 3.5 and lab.test_date is None
    assert parse.bundle_profile(patients).filter("resource_type = 'Observation'").first()["fields"] == "code,date,value"
