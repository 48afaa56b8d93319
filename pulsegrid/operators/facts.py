"""Gold facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.keys import date_key, date_key_of_string, drug_of_ndc, first_word, surrogate_key, time_key

from pulsegrid.sources.tables import seed

from .dims import LAB_CONDITIONS
from .joins import overlap_join
from .quality import flag_normal, quality_score
from .windows import anomalies, keep_first, rolling_stats, trend_deviations


def with_patient(readings: DataFrame, bridge: DataFrame) -> DataFrame:
    """patient_key: the linked person's, else one made of the account, so that no two unknown accounts are one."""
    owner = bridge.filter("identifier_type = 'device_account_id' AND patient_key IS NOT NULL").select(F.col("identifier_value").alias("device_account_id"), surrogate_key("patient_key").alias("_patient"))
    return readings.join(owner, "device_account_id", "left").withColumn("patient_key", F.coalesce("_patient", surrogate_key("device_account_id"))).drop("_patient")


def with_metric(readings: DataFrame, dim: DataFrame) -> DataFrame:
    return readings.join(dim, ["metric_name", "device_type"], "left")


def fact_vital_reading(readings: DataFrame, bridge: DataFrame, metrics: DataFrame, devices: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """Valid readings with a known metric, scored as silver has them, that is without duplicates; with alerts, is_anomaly and anomaly_type are filled from them."""
    df = with_metric(with_patient(quality_score(readings.filter("is_valid").withColumn("is_duplicate", F.lit(False))), bridge), metrics).filter("metric_key IS NOT NULL")
    df = df.join(devices.select("device_id", "firmware_version", "device_key"), ["device_id", "firmware_version"], "left")
    df = df.select(surrogate_key("reading_id", "metric_name").alias("reading_key"), "patient_key", "device_key", "metric_key", date_key("event_timestamp").alias("date_key"), time_key("event_timestamp").alias("time_key"), "metric_value", "quality_score")
    if alerts is None:
        return df.withColumn("is_anomaly", F.lit(False)).withColumn("anomaly_type", F.lit(None).cast("string"))
    found = alerts.select(F.col("alert_key").alias("reading_key"), F.col("alert_type").alias("anomaly_type"))
    return df.join(found, "reading_key", "left").withColumn("is_anomaly", F.col("anomaly_type").isNotNull()).select(*df.columns, "is_anomaly", "anomaly_type")


def fact_vital_daily_summary(readings: DataFrame, bridge: DataFrame, metrics: DataFrame, categorical: tuple[str, ...] = ("sleep_stage",)) -> DataFrame:
    """By patient, metric and day: statistics of the valid rows, all rows, the invalid ones, percent in the normal range, quartiles."""
    df = with_metric(with_patient(readings, bridge), metrics).filter(F.col("metric_key").isNotNull() & ~F.col("metric_name").isin(*categorical))
    df = flag_normal(df, "metric_value", "normal_low", "normal_high").withColumn("date_key", date_key("event_timestamp"))
    valid = F.when(F.col("is_valid"), F.col("metric_value"))
    share = 100 * F.avg((F.col("is_valid") & F.col("in_normal_range")).cast("int"))
    return df.groupBy("patient_key", "metric_key", "date_key").agg(F.avg(valid).alias("avg_value"), F.min(valid).alias("min_value"), F.max(valid).alias("max_value"), F.count("*").alias("reading_count"), F.sum((~F.col("is_valid")).cast("int")).alias("anomaly_count"), share.alias("pct_in_normal_range"), F.percentile(valid, F.lit(0.25)).alias("p25_value"), F.percentile(valid, F.lit(0.75)).alias("p75_value"))


def fact_lab_result(labs: DataFrame, bridge: DataFrame, conditions: DataFrame) -> DataFrame:
    """One row per patient, day and test: of several the latest batch's, then the largest value."""
    owner = bridge.filter("identifier_type = 'hospital_mrn'").select(F.col("identifier_value").alias("patient_id"), surrogate_key("patient_key").alias("_patient"))
    tests = seed(labs.sparkSession, LAB_CONDITIONS, "test_code string, condition_code string").join(conditions.select("condition_code", "condition_key"), "condition_code", "left").drop("condition_code")
    df = labs.join(owner, "patient_id", "left").join(tests, "test_code", "left").withColumn("patient_key", F.coalesce("_patient", surrogate_key("patient_id"))).withColumn("date_key", date_key("test_date"))
    w = Window.partitionBy("patient_key", "date_key", "test_code").orderBy(F.col("batch_date").desc(), F.col("value").desc_nulls_last(), "observation_id")
    df = df.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return df.select("patient_key", "date_key", F.col("test_code").alias("lab_test_name"), F.col("value").alias("result_value"), F.col("unit").alias("result_unit"), F.col("reference_low").alias("reference_range_low"), F.col("reference_high").alias("reference_range_high"), "is_abnormal", "condition_key")


def fact_prescription_fill(fills: DataFrame, medications: DataFrame) -> DataFrame:
    """One row per rx_id. The medication is that of the drug name's first word, else that of the code's prefix."""
    med = medications.select("medication_key", F.lower("medication_name").alias("_name"))
    df = fills.withColumn("_word", first_word("drug_name")).withColumn("_drug", drug_of_ndc("ndc_code"))
    df = df.join(med.withColumnRenamed("_name", "_word").withColumnRenamed("medication_key", "_by_word"), "_word", "left").join(med.withColumnRenamed("_name", "_drug").withColumnRenamed("medication_key", "_by_code"), "_drug", "left")
    df = df.select(surrogate_key("rx_id").alias("fill_key"), surrogate_key("pharmacy_patient_id").alias("patient_key"), F.coalesce("_by_word", "_by_code").alias("medication_key"), date_key_of_string("fill_date").alias("date_key"), F.col("days_supply").cast("int").alias("days_supply"), F.col("refill_number").cast("int").alias("refill_number"), "status")
    return keep_first(df, ["fill_key"], "date_key", "refill_number", "status", "medication_key", "patient_key", "days_supply")


def fact_anomaly_alert(readings: DataFrame, bridge: DataFrame, metrics: DataFrame, sigma: float = 2.0, days: int = 30) -> DataFrame:
    """Valid readings beyond sigma deviations of their patient's own trailing baseline, and days whose trend is (`trend_deviation`).

    A trend's alert stands at its day's last reading; its value, threshold and baseline are changes per day.
    """
    df = with_metric(with_patient(readings.filter("is_valid"), bridge), metrics).filter("metric_key IS NOT NULL")
    found = anomalies(rolling_stats(df, ["patient_key", "metric_name"], days=days), sigma=sigma)
    out = ["alert_key", "patient_key", "metric_key", "date_key", "time_key", "alert_type", "severity", "metric_value", "threshold_value", "patient_baseline"]
    single = found.withColumn("alert_key", surrogate_key("reading_id", "metric_name")).withColumn("date_key", date_key("event_timestamp")).withColumn("time_key", time_key("event_timestamp")).withColumn("patient_baseline", F.col("rolling_mean")).select(*out)
    daily = df.groupBy("patient_key", "metric_key", F.to_date("event_timestamp").alias("day")).agg(F.avg("metric_value").alias("mean"), F.max(time_key("event_timestamp")).alias("time_key"))
    trends = trend_deviations(daily, ["patient_key", "metric_key"], "day", "mean", past_days=days, sigma=sigma).withColumn("date_key", date_key("day")).withColumn("alert_type", F.lit("trend_deviation"))
    trends = trends.withColumn("alert_key", surrogate_key("patient_key", "metric_key", "date_key", F.lit("trend_deviation"))).withColumn("metric_value", F.col("slope")).withColumn("patient_baseline", F.col("slope_mean"))
    trends = trends.withColumn("threshold_value", F.col("slope_mean") + F.signum("z_score") * sigma * F.col("slope_std")).select(*out)
    return single.unionByName(trends).withColumn("resolved_flag", F.lit(False)).withColumn("resolved_timestamp", F.lit(None).cast("timestamp"))


def fact_activity_session(sessions: DataFrame, keys: list[str], rank: str, start: str = "start", end: str = "end", session_id: str = "session_id") -> DataFrame:
    """Sessions of a patient from several sources, times in seconds: one that overlaps another of a better rank (the lesser number; then the lesser id) goes."""
    better = overlap_join(sessions, sessions, keys, start, end).filter((F.col(f"{rank}_b") < F.col(rank)) | ((F.col(f"{rank}_b") == F.col(rank)) & (F.col(f"{session_id}_b") < F.col(session_id))))
    return sessions.join(better.select(session_id).distinct(), session_id, "left_anti")
