"""Flags on readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Inclusive bounds of plausible readings by metric.
VALID_BOUNDS = {"heart_rate_bpm": (30, 220), "spo2_pct": (70, 100), "steps_since_last": (0, 10000), "skin_temp_celsius": (30, 42), "hrv_ms": (5, 200), "respiration_rate": (8, 40), "sleep_stage": (0, 4), "blood_glucose_mgdl": (40, 400)}
LATE_SECONDS = 7200
VERY_LATE_SECONDS = 48 * 3600


def flag_valid(df: DataFrame, bounds: dict[str, tuple[float, float]] = VALID_BOUNDS, value: str = "metric_value", metric: str = "metric_name") -> DataFrame:
    """is_valid: false for a null value, true for a metric without bounds. The bounds are folded into the expression, so no join is needed."""
    ok: Column = F.lit(True)
    for name, (low, high) in bounds.items():
        ok = F.when(F.col(metric) == name, F.col(value).between(low, high)).otherwise(ok)
    return df.withColumn("is_valid", F.when(F.col(value).isNull(), False).otherwise(ok))


def flag_late(df: DataFrame, event: str = "event_timestamp", sync: str = "sync_timestamp", seconds: int = LATE_SECONDS, name: str = "is_late_arriving") -> DataFrame:
    """True if it was synchronised strictly more than `seconds` after the event; unknown clocks are not late."""
    return df.withColumn(name, F.coalesce(F.unix_timestamp(sync) - F.unix_timestamp(event) > seconds, F.lit(False)))


def flag_normal(df: DataFrame, value: str, low: str, high: str, name: str = "in_normal_range") -> DataFrame:
    """False where any side is null."""
    return df.withColumn(name, F.coalesce(F.col(value).between(F.col(low), F.col(high)), F.lit(False)))


def flag_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("is_duplicate", F.count("*").over(Window.partitionBy(*keys)) > 1)


def quality_score(df: DataFrame) -> DataFrame:
    """0 for an invalid reading; else 1, less 0.25 if late and 0.25 if duplicate."""
    return df.withColumn("quality_score", F.when(~F.col("is_valid"), 0.0).otherwise(1.0 - 0.25 * F.col("is_late_arriving").cast("double") - 0.25 * F.col("is_duplicate").cast("double")))
