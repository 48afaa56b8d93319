from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pulsegrid.operators import facts, joins, windows


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("k", None, "n"), (None, 5, "x")], "k string, t int, v string")
    assert {r.v for r in windows.keep_first(df, ["k"], "t", "v").collect()} == {"a", "x"}
    assert {r.v for r in windows.keep_latest(df, ["k"], "t", "v").collect()} == {"b", "x"}


def test_rolling_stats_and_anomalies(spark):
    day = 86400
    rows = [(1, 0, 10.0), (1, day, 12.0), (1, 2 * day, 11.0), (1, 31 * day, 50.0), (2, 0, 5.0)]
    df = spark.createDataFrame(rows, "k int, s long, metric_value double").withColumn("event_timestamp", F.timestamp_seconds("s"))
    got = {(r.k, r.s): (r.rolling_mean, r.rolling_std) for r in windows.rolling_stats(df, ["k"]).collect()}
    assert got[(1, 31 * day)][0] == (12.0 + 11.0 + 50.0) / 3 and got[(2, 0)] == (5.0, None)
    flat = spark.createDataFrame([(11.0, 10.0, 0.1), (15.0, 10.0, 1.0), (7.6, 10.0, 1.0), (9.0, 10.0, 1.0), (9.0, 9.0, 0.0)], "metric_value double, rolling_mean double, rolling_std double")
    out = [(r.alert_type, r.severity, round(r.threshold_value, 4)) for r in windows.anomalies(flat).collect()]
    assert out == [("sudden_spike", "critical", 10.2), ("sudden_spike", "critical", 12.0), ("sustained_low", "medium", 8.0)]


def test_runs_sessions_trend_gaps(spark):
    df = spark.createDataFrame([("k", i, i in (2, 3, 4, 7)) for i in range(9)], "k string, i int, f boolean")
    assert [tuple(r) for r in windows.runs(df, ["k"], ["i"], F.col("f"), 2).collect()] == [("k", 2, 4, 3)]
    e = spark.createDataFrame([("u", s) for s in (0, 60, 120, 500)], "u string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = windows.sessions(e, ["u"], "ts", 60).select(F.unix_timestamp("session_start"), F.unix_timestamp("session_end"), "n").collect()
    assert sorted(tuple(r) for r in got) == [(0, 120, 3), (500, 500, 1)]
    d = spark.createDataFrame([("m", date(2024, 1, k), float(v)) for k, v in ((1, 10), (2, 20), (3, 15), (20, 1))], "m string, d date, v double")
    assert [r.direction for r in windows.trend(d, ["m"], "d", "v").orderBy("d").collect()] == [None, "up", "stable", None]
    f = spark.createDataFrame([("p", date(2024, 1, 1), 10), ("p", date(2024, 1, 11), 10), ("p", date(2024, 1, 30), 10)], "p string, d date, n int")
    assert [(r.gap_days, r.is_gap) for r in windows.refill_gaps(f, ["p"], "d", "n", "d").orderBy("d").collect()] == [(None, False), (0, False), (9, True)]


def test_point_in_time(spark):
    dim = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(2024, 1, 10)), (1, "b", date(2024, 1, 10), None)], "k int, v string, effective_start date, effective_end date")
    fact = spark.createDataFrame([(1, date(2023, 12, 31)), (1, date(2024, 1, 9)), (1, date(2024, 1, 10)), (2, date(2024, 1, 1))], "k int, at date")
    got = {(r.k, str(r["at"])): r.v for r in joins.asof_scd2(fact, dim, ["k"], "at").collect()}
    assert got == {(1, "2023-12-31"): None, (1, "2024-01-09"): "a", (1, "2024-01-10"): "b", (2, "2024-01-01"): None}


def test_proximity_equals_brute_force(spark):
    days = [0, 1, 6, 7, 8, 13, 14, 15, 30]
    a = spark.createDataFrame([(k, d) for k in (1, 2) for d in days], "k int, n int").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")))
    for width in (0, 1, 7):
        got = sorted((r.k, r.n, r.n_b) for r in joins.proximity_join(a, a, ["k"], "d", width).collect())
        assert got == sorted((k, x, y) for k in (1, 2) for x in days for y in days if abs(x - y) <= width)


def test_overlap_and_sessions(spark):
    rows = [("a", "p", 0, 10, 1), ("b", "p", 5, 15, 2), ("c", "p", 10, 12, 1), ("d", "q", 0, 10, 9)]
    s = spark.createDataFrame(rows, "session_id string, patient string, start int, end int, rank int")
    assert {(r.session_id, r.session_id_b) for r in joins.overlap_join(s, s, ["patient"]).filter("session_id < session_id_b").collect()} == {("a", "b"), ("b", "c")}
    assert {r.session_id for r in facts.fact_activity_session(s, ["patient"], "rank").collect()} == {"a", "c", "d"}


def test_orphans_ignore_nulls(spark):
    c = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    p = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r.fk for r in joins.orphans(c, "fk", p, "id").collect()] == [2]


def test_runs_go_across_parts(spark):
    import random

    r = random.Random(4)
    data = [(r.choice(["a", "b", None]), k, r.random() < 0.85) for k in range(1500) if not 200 <= k < 300]
    df = spark.createDataFrame(data, "t string, k long, f boolean")
    for width in (3, 64, 5000):
        got = windows.runs_in_parts(df, ["t"], ["k"], F.col("f"), F.floor(F.col("k") / width), 4).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, windows.runs(df, ["t"], ["k"], F.col("f"), 4).collect()), key=str)
