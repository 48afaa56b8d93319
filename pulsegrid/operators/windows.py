"""Deduplication, rolling baselines, anomalies, trends, runs, sessions and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIGMA = 2.0


def keep_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order. The order must be total over the columns that are used afterwards, else which of several tied rows stays is left to chance."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return keep_one(df, keys, *[F.col(c).asc_nulls_last() for c in order])


def keep_latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return keep_one(df, keys, *[F.col(c).desc_nulls_last() for c in order])


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def most_first(df: DataFrame, *by: str) -> DataFrame:
    """df in falling order of the first column, then in rising order of the others."""
    return df.orderBy(F.col(by[0]).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in by[1:]])


def newest(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The rows that come last in the order; each task keeps so many at most."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(rows)


def rolling_stats(df: DataFrame, keys: list[str], ts: str = "event_timestamp", value: str = "metric_value", days: int = 30) -> DataFrame:
    """Mean and sample deviation over the trailing days, the row itself and its peers of the same second included.

    The order key is a column, so that one sort serves both windows.
    """
    df = df.withColumn("_s", F.unix_timestamp(ts))
    w = Window.partitionBy(*keys).orderBy("_s").rangeBetween(-days * 86400, 0)
    return df.withColumn("rolling_mean", F.avg(value).over(w)).withColumn("rolling_std", F.stddev_samp(value).over(w)).drop("_s")


def classify(z: Column, sigma: float = SIGMA) -> Column:
    return F.when(F.abs(z) > 3, "sudden_spike").when(z > sigma, "sustained_high").when(z < -sigma, "sustained_low")


def severity(z: Column, sigma: float = SIGMA) -> Column:
    return F.when(F.abs(z) > 4, "critical").when(F.abs(z) > 3, "high").when(F.abs(z) > sigma, "medium").otherwise("low")


def anomalies(stats: DataFrame, value: str = "metric_value", sigma: float = SIGMA) -> DataFrame:
    """Rows beyond sigma deviations of their own baseline, with z_score, alert_type, severity and the threshold on their side."""
    z = (F.col(value) - F.col("rolling_mean")) / F.col("rolling_std")
    df = stats.filter("rolling_std > 0").withColumn("z_score", z).filter(F.abs("z_score") > sigma)
    z = F.col("z_score")
    return df.withColumn("alert_type", classify(z, sigma)).withColumn("severity", severity(z, sigma)).withColumn("threshold_value", F.col("rolling_mean") + F.signum(z) * sigma * F.col("rolling_std"))


def trend(daily: DataFrame, keys: list[str], day: str, value: str, days: int = 7, flat: float = 0.0) -> DataFrame:
    """Change against the mean of the days before: percent and direction (stable within `flat` percent)."""
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(-days, -1)
    df = daily.withColumn("_d", F.datediff(F.col(day), F.lit("1970-01-01"))).withColumn("moving_avg", F.avg(value).over(w)).drop("_d")
    df = df.withColumn("pct_change", 100 * F.try_divide(F.col(value) - F.col("moving_avg"), F.col("moving_avg")))
    return df.withColumn("direction", F.when(F.col("pct_change").isNull(), None).when(F.col("pct_change") > flat, "up").when(F.col("pct_change") < -flat, "down").otherwise("stable"))


def slopes(daily: DataFrame, keys: list[str], day: str, value: str, days: int = 7, least: int = 3) -> DataFrame:
    """slope: the least-squares change of the value per day over the trailing days, the day itself included; null where these have fewer than `least` rows or no slope. One row for each key and day."""
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(1 - days, 0)
    df = daily.withColumn("_d", F.datediff(F.col(day), F.lit("1970-01-01")))
    return df.withColumn("slope", F.when(F.count(value).over(w) >= least, F.regr_slope(F.col(value), F.col("_d")).over(w))).drop("_d")


def trend_deviations(daily: DataFrame, keys: list[str], day: str, value: str, days: int = 7, least: int = 3, past_days: int = 30, least_past: int = 5, sigma: float = SIGMA) -> DataFrame:
    """Days whose slope lies beyond sigma deviations of the key's own slopes of the days before: slope, slope_mean, slope_std, z_score and severity.

    Frames are of days, so they hold a bounded number of rows whatever the series' length. Days without a slope are no alerts
    and don't count as past ones; at least `least_past` of these are needed.
    """
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(-past_days, -1)
    df = slopes(daily, keys, day, value, days, least).withColumn("_d", F.datediff(F.col(day), F.lit("1970-01-01")))
    df = df.withColumn("slope_mean", F.avg("slope").over(w)).withColumn("slope_std", F.stddev_samp("slope").over(w)).withColumn("_n", F.count("slope").over(w))
    df = df.filter((F.col("_n") >= least_past) & (F.col("slope_std") > 0)).withColumn("z_score", (F.col("slope") - F.col("slope_mean")) / F.col("slope_std"))
    return df.filter(F.abs("z_score") > sigma).withColumn("severity", severity(F.col("z_score"), sigma)).drop("_d", "_n")


def runs(df: DataFrame, keys: list[str], order: list[str], flag: Column, least: int = 3) -> DataFrame:
    """Runs of at least `least` consecutive rows where the flag holds: keys, run_start, run_end, run_length."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_f", F.coalesce(flag, F.lit(False)))
    df = df.withColumn("_i", F.row_number().over(w) - F.sum(F.col("_f").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_f")
    return df.groupBy(*keys, "_i").agg(F.min(order[0]).alias("run_start"), F.max(order[0]).alias("run_end"), F.count("*").alias("run_length")).filter(F.col("run_length") >= least).drop("_i")


def runs_in_parts(df: DataFrame, keys: list[str], order: list[str], flag: Column, part: Column, least: int = 3) -> DataFrame:
    """As `runs`, for few keys with many rows: part never falls along the order; rows are sorted within their part, and only the runs at the ends of parts meet in one window by key."""
    df = df.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_p", part)
    whole = Window.partitionBy(*keys, "_p")
    w = whole.orderBy(*order)
    pos = df.withColumn("_r", F.row_number().over(w)).withColumn("_n", F.count("*").over(whole))
    pos = pos.withColumn("_i", F.col("_r") - F.sum(F.col("_f").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_f")
    pieces = pos.groupBy(*keys, "_p", "_i").agg(F.min(order[0]).alias("run_start"), F.max(order[0]).alias("run_end"), F.count("*").alias("run_length"), (F.min("_r") == 1).alias("_first"), (F.max("_r") == F.max("_n")).alias("_last"))
    by_key = Window.partitionBy(*keys).orderBy("_p")
    parts = df.groupBy(*keys, "_p").agg(F.lit(1).alias("_one")).withColumn("_before", F.lag("_p").over(by_key)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_p").alias("_q"), "_before")
    on = F.col("_p").eqNullSafe(F.col("_q"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    at = Window.partitionBy(*keys).orderBy("_p", "_i")
    goes_on = F.col("_first") & F.coalesce(F.lag("_last").over(at), F.lit(False)) & F.lag("_p").over(at).eqNullSafe(F.col("_before"))
    ends = pieces.filter("_first OR _last").join(parts, on).withColumn("_new", (~goes_on).cast("int"))
    ends = ends.withColumn("_no", F.sum("_new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    joined = ends.groupBy(*keys, "_no").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("run_length").alias("run_length"))
    out = [*keys, "run_start", "run_end", "run_length"]
    return pieces.filter("NOT (_first OR _last)").select(*out).unionByName(joined.select(*out)).filter(F.col("run_length") >= least)


def sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int) -> DataFrame:
    """keys, session_start, session_end, n: rows of a key with no gap of more than gap_seconds between them."""
    df = df.withColumn("_s", F.unix_timestamp(ts))
    w = Window.partitionBy(*keys).orderBy("_s")
    df = df.withColumn("_new", (F.coalesce(F.col("_s") - F.lag("_s").over(w), F.lit(gap_seconds + 1)) > gap_seconds).cast("int"))
    df = df.withColumn("_no", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*keys, "_no").agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("n")).drop("_no")


def refill_gaps(fills: DataFrame, keys: list[str], date: str, days_supply: str, fill_id: str) -> DataFrame:
    """gap_days between a fill and the end of the previous fill's supply; is_gap if any. Fills of a day come in the order of their ids."""
    w = Window.partitionBy(*keys).orderBy(date, fill_id)
    end = F.lag(F.date_add(F.col(date), F.col(days_supply).cast("int"))).over(w)
    return fills.withColumn("supply_end", end).withColumn("gap_days", F.datediff(F.col(date), F.col("supply_end"))).withColumn("is_gap", F.coalesce(F.col("gap_days") > 0, F.lit(False)))
