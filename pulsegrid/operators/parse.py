"""Parsing: sensor events, metric explosion, change envelopes and the three clinical resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.keys import row_hash

EVENT = "reading_id string, device_id string, device_type string, user_device_account_id string, metrics map<string,string>, firmware_version string, battery_pct string, event_timestamp string, sync_timestamp string"
AFTER = "rx_id string, pharmacy_patient_id string, ndc_code string, drug_name string, fill_date string, days_supply int, refill_number int, status string"
CHANGE = f"op string, before struct<{AFTER}>, after struct<{AFTER}>, ts_ms long"


def instant(c: Column) -> Column:
    """ISO-8601 text to a timestamp, null if malformed."""
    return F.try_to_timestamp(c)


def parse_readings(bronze: DataFrame) -> DataFrame:
    """Columns of a sensor event from raw_value, parsed once; malformed JSON gives nulls."""
    e = F.from_json("raw_value", EVENT)
    df = bronze.select(e.alias("e"), "ingestion_timestamp")
    return df.select("e.reading_id", "e.device_id", "e.device_type", F.col("e.user_device_account_id").alias("device_account_id"), "e.firmware_version", F.col("e.battery_pct").try_cast("int").alias("battery_pct"), instant(F.col("e.event_timestamp")).alias("event_timestamp"), instant(F.col("e.sync_timestamp")).alias("sync_timestamp"), "ingestion_timestamp", "e.metrics")


def explode_metrics(df: DataFrame, column: str = "metrics") -> DataFrame:
    """A row per metric; null values stay, and a value that is no number stays as metric_text."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias("metric_name", "metric_text")).withColumn("metric_value", F.col("metric_text").try_cast("double"))


def parse_changes(bronze: DataFrame, operations: tuple[str, ...] = ("c", "u", "d")) -> DataFrame:
    """(op, ts_ms, kafka_offset, columns of the row): after for creates and updates, before for deletes; rows without a key go."""
    df = bronze.select(F.from_json("raw_value", CHANGE).alias("e"), "kafka_offset")
    row = F.when(F.col("e.op") == "d", F.coalesce("e.before", "e.after")).otherwise(F.col("e.after"))
    return df.select("e.op", "e.ts_ms", "kafka_offset", row.alias("r")).filter(F.col("op").isin(*operations) & F.col("r.rx_id").isNotNull()).select("op", "ts_ms", "kafka_offset", "r.*")


def _entries(patients: DataFrame, kind: str) -> DataFrame:
    df = patients.select("patient_id", "patient_email", "batch_date", F.explode("entries").alias("e"))
    return df.filter(F.col("e.resource_type") == kind)


def conditions(patients: DataFrame) -> DataFrame:
    df = _entries(patients, "Condition").select("patient_id", "patient_email", F.col("e.code").alias("icd10_code"), "e.description", "e.category", "e.is_chronic", F.col("e.onset_date").try_cast("date").alias("onset_date"), "e.status", "e.clinician_npi", "batch_date")
    return df.withColumn("row_hash", row_hash("status", "icd10_code"))


def medications(patients: DataFrame) -> DataFrame:
    """Versions: a medication without an end date, or with another status than stopped, is current."""
    df = _entries(patients, "MedicationStatement").select("patient_id", "patient_email", "e.medication", "e.generic_name", "e.drug_class", "e.dosage", "e.frequency", F.col("e.start_date").try_cast("date").alias("start_date"), F.col("e.end_date").try_cast("date").alias("end_date"), "e.status", "e.prescriber_npi", "batch_date")
    df = df.withColumn("effective_start", F.col("start_date")).withColumn("effective_end", F.col("end_date")).withColumn("is_current", F.col("end_date").isNull())
    return df.withColumn("row_hash", row_hash("status", "dosage", "frequency"))


def labs(patients: DataFrame) -> DataFrame:
    df = _entries(patients, "Observation").select("patient_id", "patient_email", F.col("e.code").alias("test_code"), "e.value", "e.unit", "e.reference_low", "e.reference_high", "e.is_abnormal", F.col("e.date").try_cast("date").alias("test_date"), "batch_date")
    return df.withColumn("observation_id", F.sha2(F.concat_ws("|", "patient_id", "test_code", F.col("test_date").cast("string"), F.col("value").cast("string")), 256))


def bundle_profile(patients: DataFrame) -> DataFrame:
    """Entries, patients and filled fields of each resource type."""
    df = patients.select("patient_id", F.explode("entries").alias("e"))
    fields = F.filter(F.json_object_keys(F.to_json("e")), lambda k: k != "resource_type")
    return df.groupBy(F.col("e.resource_type").alias("resource_type")).agg(F.count("*").alias("entries"), F.countDistinct("patient_id").alias("patients"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(fields)))), ",").alias("fields"))
