"""Quality, health and history checks as report tables: (check, object, value, status)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import orphans

#: Sizes, relations, columns without nulls and grains of the gold tables, names of personal columns, bounds.
EXPECTED_COUNTS = {"dim_date": 1096, "dim_time": 1440, "dim_condition_category": 6, "dim_drug_class": 6, "dim_metric": 13}
FOREIGN_KEYS = [("dim_condition", "condition_category_key", "dim_condition_category"), ("dim_medication", "drug_class_key", "dim_drug_class"), ("dim_device", "patient_key", "dim_patient"), ("fact_vital_reading", "patient_key", "dim_patient"), ("fact_vital_reading", "metric_key", "dim_metric"), ("fact_vital_daily_summary", "patient_key", "dim_patient"), ("fact_vital_daily_summary", "metric_key", "dim_metric"), ("fact_lab_result", "patient_key", "dim_patient"), ("fact_prescription_fill", "patient_key", "dim_patient"), ("fact_prescription_fill", "medication_key", "dim_medication"), ("fact_anomaly_alert", "patient_key", "dim_patient"), ("fact_anomaly_alert", "metric_key", "dim_metric")]
NOT_NULL = {"dim_patient": ["patient_key", "age_group", "gender"], "dim_device": ["device_key", "device_id", "device_type"], "fact_vital_reading": ["reading_key", "patient_key", "metric_key", "date_key", "metric_value"], "fact_vital_daily_summary": ["patient_key", "metric_key", "date_key", "avg_value"], "fact_lab_result": ["patient_key", "date_key", "lab_test_name", "result_value"], "fact_prescription_fill": ["fill_key", "patient_key", "date_key"], "fact_anomaly_alert": ["alert_key", "patient_key", "metric_key", "alert_type", "severity"]}
GRAINS = {"dim_patient": ["patient_key"], "dim_device": ["device_key"], "dim_metric": ["metric_name", "device_type"], "fact_vital_reading": ["reading_key"], "fact_vital_daily_summary": ["patient_key", "metric_key", "date_key"], "fact_lab_result": ["patient_key", "date_key", "lab_test_name"], "fact_prescription_fill": ["fill_key"]}
PERSONAL_COLUMNS = {"email", "patient_email", "phone", "address", "ssn", "dob", "date_of_birth", "first_name", "last_name", "full_name", "mrn", "hospital_mrn"}
PERSONAL_VALUES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}", "phone": r"\+[0-9][0-9 ().-]{8,}[0-9]", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"}
PLAUSIBLE = {"heart_rate_bpm": (20, 300), "spo2_pct": (50, 100), "blood_glucose_mgdl": (20, 800), "skin_temp_celsius": (25, 45), "respiration_rate": (5, 60), "steps_since_last": (0, 100000)}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row(name: str, obj: str | Column, value: Column, status: Column) -> list[Column]:
    return [F.lit(name).alias("check"), (F.lit(obj) if isinstance(obj, str) else obj).alias("object"), value.cast("double").alias("value"), status.alias("status")]


def check_counts(tables: dict[str, DataFrame], expected: dict[str, int] = EXPECTED_COUNTS) -> DataFrame:
    parts = []
    for name, df in tables.items():
        n = F.col("n")
        good = n == expected[name] if name in expected else n > 0
        parts.append(df.agg(F.count("*").alias("n")).select(*_row("row_count", name, n, F.when(good, "ok").when(n == 0, "warn").otherwise("fail"))))
    return _union(parts)


def check_foreign_keys(tables: dict[str, DataFrame], relations: list[tuple[str, str, str]] = FOREIGN_KEYS) -> DataFrame:
    """Orphans of each relation whose two tables are given; the parent's key has the same name."""
    parts = [orphans(tables[c].select(k), k, tables[p].select(k).distinct(), k).agg(F.count("*").alias("n")).select(*_row("foreign_key", f"{c}.{k} -> {p}", F.col("n"), F.when(F.col("n") == 0, "ok").otherwise("fail"))) for c, k, p in relations if c in tables and p in tables]
    return _union(parts)


def check_not_null(tables: dict[str, DataFrame], columns: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    """Nulls of all columns of a table in one pass."""
    parts = []
    for name, cols in columns.items():
        if name in tables:
            counts = tables[name].agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
            pairs = F.explode(F.array(*[F.struct(F.lit(f"{name}.{c}").alias("object"), F.coalesce(F.col(c), F.lit(0)).alias("n")) for c in cols]))
            parts.append(counts.select(pairs.alias("x")).select(*_row("not_null", F.col("x.object"), F.col("x.n"), F.when(F.col("x.n") == 0, "ok").otherwise("fail"))))
    return _union(parts)


def check_personal_columns(spark: SparkSession, tables: dict[str, DataFrame], names: set[str] = PERSONAL_COLUMNS) -> DataFrame:
    rows = [("personal_column", f"{t}.{c}", 1.0, "fail") for t, df in tables.items() for c in df.columns if c.lower() in names]
    return spark.createDataFrame(rows, "check string, object string, value double, status string")


def check_grain(tables: dict[str, DataFrame], grains: dict[str, list[str]] = GRAINS) -> DataFrame:
    """Keys that occur more than once."""
    parts = [tables[t].groupBy(*cols).count().filter("count > 1").agg(F.count("*").alias("n")).select(*_row("grain", t, F.col("n"), F.when(F.col("n") == 0, "ok").otherwise("fail"))) for t, cols in grains.items() if t in tables]
    return _union(parts)


def check_plausible(readings: DataFrame, bounds: dict[str, tuple[float, float]] = PLAUSIBLE) -> DataFrame:
    """Values out of clinical bounds by metric: a warning, no failure."""
    out = F.lit(False)
    for name, (low, high) in bounds.items():
        out = F.when(F.col("metric_name") == name, ~F.col("metric_value").between(low, high)).otherwise(out)
    df = readings.filter(F.col("metric_name").isin(*bounds)).groupBy("metric_name").agg(F.sum(F.coalesce(out, F.lit(False)).cast("long")).alias("n"))
    return df.select(*_row("plausible", F.col("metric_name"), F.col("n"), F.when(F.col("n") == 0, "ok").otherwise("warn")))


def identity_coverage(readings: DataFrame, bridge: DataFrame) -> DataFrame:
    """Linked device accounts, and readings of linked accounts, in percent."""
    linked = bridge.filter("identifier_type = 'device_account_id' AND link_status = 'linked'").select(F.col("identifier_value").alias("device_account_id"), F.lit(1).alias("_l")).distinct()
    each = readings.groupBy("device_account_id").agg(F.count("*").alias("n")).filter("device_account_id IS NOT NULL").join(linked, "device_account_id", "left")
    hit = F.coalesce("_l", F.lit(0))
    df = each.agg((100 * F.avg(hit)).alias("accounts"), (100 * F.sum(hit * F.col("n")) / F.sum("n")).alias("readings"))
    df = df.select(F.explode(F.array(F.struct(F.lit("accounts").alias("object"), F.col("accounts").alias("v")), F.struct(F.lit("readings").alias("object"), F.col("readings").alias("v")))).alias("x"))
    v = F.col("x.v")
    return df.select(*_row("identity_coverage", F.col("x.object"), v, F.when(v >= 95, "ok").when(v >= 80, "warn").otherwise("fail")))


def lineage(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count("*").alias("n")).select(*_row("lineage", name, F.col("n"), F.lit("info"))) for name, df in tables.items()])


def anomaly_rate(readings: DataFrame, alerts: DataFrame, devices: DataFrame) -> DataFrame:
    """Alerts in percent of readings, overall and by firmware."""
    df = readings.select("reading_key", "device_key").join(alerts.select(F.col("alert_key").alias("reading_key"), F.lit(1).alias("_a")), "reading_key", "left").join(devices.select("device_key", "firmware_version"), "device_key", "left")
    by = df.groupBy("firmware_version").agg(F.count("*").alias("n"), F.count("_a").alias("a"))
    rate = 100 * F.try_divide(F.col("a"), F.col("n"))
    firmware = by.select(*_row("anomaly_rate", F.concat(F.lit("firmware "), F.coalesce("firmware_version", F.lit("unknown"))), rate, F.when(rate > 15, "investigate").otherwise("ok")))
    whole = by.agg(F.sum("n").alias("n"), F.sum("a").alias("a")).select(*_row("anomaly_rate", "all", rate, F.when(rate > 10, "warn_high").when(rate > 5, "warn").otherwise("ok")))
    return whole.unionByName(firmware)


def audit_scd2(df: DataFrame, keys: list[str], start: str = "effective_start", end: str = "effective_end", current: str = "is_current") -> DataFrame:
    """Keys without exactly one current version, current versions with an end, closed ones without, overlaps, gaps, empty versions. One sort by key."""
    w = Window.partitionBy(*keys).orderBy(start, F.col(end).asc_nulls_last())
    far = F.lit("9999-12-31").cast("date")
    reach = F.max(F.coalesce(F.col(end).cast("date"), far)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_overlap", F.coalesce(F.col(start).cast("date") < reach, F.lit(False))).withColumn("_gap", F.coalesce(F.lead(start).over(w) > F.col(end), F.lit(False)))
    n = lambda c: F.sum(c.cast("long"))
    by_key = rows.groupBy(*keys).agg(n(F.col(current)).alias("live"), n(F.col(current) & F.col(end).isNotNull()).alias("current_with_end"), n(~F.col(current) & F.col(end).isNull()).alias("closed_without_end"), n(F.col("_overlap")).alias("overlap"), n(F.col("_gap")).alias("gap"), n(F.coalesce(F.col(end) <= F.col(start), F.lit(False))).alias("empty_version"))
    names = ["several_current", "no_current", "current_with_end", "closed_without_end", "overlap", "gap", "empty_version"]
    total = by_key.agg(n(F.col("live") > 1).alias("several_current"), n(F.col("live") == 0).alias("no_current"), *[F.sum(c).alias(c) for c in names[2:]])
    x = total.select(F.explode(F.array(*[F.struct(F.lit(c).alias("object"), F.coalesce(F.col(c), F.lit(0)).alias("v")) for c in names])).alias("x"))
    soft = F.col("x.object").isin("closed_without_end", "gap", "no_current")
    return x.select(*_row("scd2", F.col("x.object"), F.col("x.v"), F.when(F.col("x.v") == 0, "ok").when(soft, "warn").otherwise("fail")))


def personal_values(df: DataFrame, table: str, patterns: dict[str, str] = PERSONAL_VALUES) -> DataFrame:
    """Rows of every string column that hold something like personal data; one pass."""
    cols = [c for c, t in df.dtypes if t == "string"]
    counts = df.agg(*[F.sum(F.coalesce(F.col(c).rlike(p), F.lit(False)).cast("long")).alias(f"{c}|{k}") for c in cols for k, p in patterns.items()])
    x = counts.select(F.explode(F.array(*[F.struct(F.lit(f"{table}.{c} {k}").alias("object"), F.coalesce(F.col(f"`{c}|{k}`"), F.lit(0)).alias("v")) for c in cols for k in patterns])).alias("x"))
    return x.select(*_row("personal_value", F.col("x.object"), F.col("x.v"), F.when(F.col("x.v") == 0, "ok").otherwise("fail")))


def summary_invariants(daily: DataFrame) -> DataFrame:
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    x = daily.agg(n((F.col("avg_value") < F.col("min_value") - 1e-9) | (F.col("avg_value") > F.col("max_value") + 1e-9)).alias("a"), n(F.col("reading_count") <= 0).alias("b")).select(F.explode(F.array(F.struct(F.lit("avg within min and max").alias("object"), F.col("a").alias("v")), F.struct(F.lit("reading_count positive").alias("object"), F.col("b").alias("v")))).alias("x"))
    return x.select(*_row("invariant", F.col("x.object"), F.col("x.v"), F.when(F.col("x.v") == 0, "ok").otherwise("fail")))


def silver_profile(readings: DataFrame) -> DataFrame:
    """Rows by device type, metric, validity and lateness."""
    return readings.groupBy("device_type", "metric_name", "is_valid", "is_late_arriving").agg(F.count("*").alias("n"))


def stream_health(spark: SparkSession, progress: list[dict], max_lag_s: float = 300, max_batch_s: float = 30) -> DataFrame:
    """From a query's recentProgress: each batch's duration, rows, and lag, which is its start less its newest event; null without a watermark, which is what makes Spark report event times."""
    rows = [(int(p["batchId"]), float(p.get("batchDuration", 0)) / 1000, float(p.get("numInputRows", 0)), p.get("timestamp"), (p.get("eventTime") or {}).get("max")) for p in progress]
    df = spark.createDataFrame(rows, "batch long, seconds double, rows double, at string, newest string")
    lag = F.unix_timestamp(F.try_to_timestamp("at")) - F.unix_timestamp(F.try_to_timestamp("newest"))
    return df.select("batch", "seconds", "rows", lag.cast("double").alias("lag_s"), F.when((F.col("seconds") > max_batch_s) | (lag > max_lag_s), "warn").otherwise("ok").alias("status"))
