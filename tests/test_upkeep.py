"""Keyed tables, layout, footers, health, rejected lines, slopes and sessions against plain versions."""

from __future__ import annotations

import glob
import io
import os
import random
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.operators import dims, windows
from pulsegrid.session import settings
from pulsegrid.sources import keyed, layout
from pulsegrid.sources import tables as T
from pulsegrid.streaming import health, ingest

ROWS = "k long, day int, at long, v string"


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def plain(rows, latest=False):
    best = {}
    for r in rows:
        if r[0] not in best or ((r[2] or 0) > (best[r[0]][2] or 0) if latest else (r[2] is None, r[2]) < (best[r[0]][2] is None, best[r[0]][2])):
            best[r[0]] = r
    return sorted(best.values())


@pytest.mark.parametrize("latest", [False, True])
def test_merges_equal_one_load_and_touch_only_their_partitions(spark, folder, latest):
    r = random.Random(1)
    every, path = [], f"{folder}/t"
    for step in range(5):
        new = [(k := r.randrange(200), k % 4, 1000 * step + i if i % 9 else None, f"v{step}-{i}") for i in range(120)]
        keyed.merge_into(path, spark.createDataFrame(new, ROWS).repartition(3), ["k"], ["at"], f"s{step}", buckets=4, parts=("day",), latest=latest)
        every += new
    got = keyed.read_keyed(spark, path)
    known = {(x[0], x[2]) for x in plain(every, latest)}
    assert {(x.k, x["at"]) for x in got.select("k", "at").collect()} == known and got.count() == len(known)
    assert len(files(path)) == 16
    before = files(path)
    again = spark.createDataFrame([x for x in every if x[1] == 2], ROWS)
    assert keyed.merge_into(path, again, ["k"], ["at"], "again", buckets=4, parts=("day",), latest=latest) == 4
    assert {(x.k, x["at"]) for x in keyed.read_keyed(spark, path).select("k", "at").collect()} == known
    assert {f for f in before if "day=2" not in f} == {f for f in files(path) if "day=2" not in f}
    with pytest.raises(ValueError, match="partitioned by"):
        keyed.merge_into(path, again, ["k"], ["at"], "other", buckets=5, parts=("day",))


def test_a_merge_that_was_cut_short_ends_when_it_is_repeated(spark, folder, monkeypatch):
    path = f"{folder}/t"
    df = spark.createDataFrame([(k, k % 2, k, "a") for k in range(40)], ROWS)
    keyed.merge_into(path, df, ["k"], ["at"], "0", buckets=2, parts=("day",))
    new = spark.createDataFrame([(k, k % 2, k - 1, "b") for k in range(80)], ROWS)
    move, moved = keyed.Files.move, []

    def break_off(self, a, b):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(b)
        move(self, a, b)

    monkeypatch.setattr(keyed.Files, "move", break_off)
    with pytest.raises(OSError):
        keyed.merge_into(path, new, ["k"], ["at"], "1", buckets=2, parts=("day",))
    monkeypatch.setattr(keyed.Files, "move", move)
    keyed.merge_into(path, new, ["k"], ["at"], "1", buckets=2, parts=("day",))
    assert sorted((x.k, x["at"], x.v) for x in keyed.read_keyed(spark, path).collect()) == [(k, k - 1, "b") for k in range(80)]


def test_nulls_and_empty_sources(spark, folder):
    path = f"{folder}/t"
    assert keyed.merge_into(path, spark.createDataFrame([], ROWS), ["k"], ["at"], "0", buckets=2) == 0
    rows = [(None, 1, 5, "x"), (None, 1, None, "y"), (1, None, None, None)]
    keyed.merge_into(path, spark.createDataFrame(rows, ROWS), ["k"], ["at"], "1", buckets=2, parts=("day",))
    keyed.merge_into(path, spark.createDataFrame(rows[:2], ROWS), ["k"], ["at"], "2", buckets=2, parts=("day",))
    assert sorted((tuple(r) for r in keyed.read_keyed(spark, path).select("k", "day", "at", "v").collect()), key=str) == [(1, None, None, None), (None, 1, 5, "x")]


def test_erasure_by_file(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(k, k % 5, k, f"v{k}") for k in range(50)], ROWS)
    df.repartition("day").write.partitionBy("day").parquet(path)
    before = files(path)
    assert keyed.erase_in(path, spark.createDataFrame([(10,), (20,), (999,)], "k long"), "k", ["v"], ["day"], "e") == (1, 1)
    assert {(r.k, r.v) for r in spark.read.parquet(path).select("k", "v").collect()} == {(k, None if k in (10, 20) else f"v{k}") for k in range(50)}
    assert {f for f in before if "day=0" not in f} < set(files(path)) and not set(files(path)) & {f for f in before if "day=0" in f}
    assert keyed.erase_in(path, spark.createDataFrame([(999,)], "k long"), "k", ["v"], ["day"], "e") == (0, 0)


def test_the_curve_keeps_near_rows_together(spark, folder):
    r = random.Random(3)
    rows = [(r.randrange(1000), r.randrange(1000), k) for k in range(4000)] + [(None, 5, -1), (5, None, -2)]
    df = spark.createDataFrame(rows, "a int, b int, k int")
    opened = {}
    for curve in (True, False):
        layout.write_clustered(df, f"{folder}/{curve}", ["a", "b"], 64, curve)
        for c in "ab":
            got, opened[curve, c], all_files = layout.read_within(spark, f"{folder}/{curve}", {c: (100, 160)})
            assert {x.k for x in got.collect()} == {k for *ab, k in rows if ab["ab".index(c)] is not None and 100 <= ab["ab".index(c)] <= 160} and all_files == 64
    assert max(opened[True, "a"], opened[True, "b"]) <= 24 and opened[False, "a"] <= 8 and opened[False, "b"] > 55


def test_footers_read_no_column(spark, folder):
    spark.range(1000).select("id", (F.col("id") * 0.5).alias("x"), (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(f"{folder}/t")
    with settings(spark, layout.FOOTERS_ONLY):
        out = io.StringIO()
        with redirect_stdout(out):
            layout.footer_query(spark, f"{folder}/t", ["id", "x"], ["p"]).explain("formatted")
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(x), MAX(x)]" in out.getvalue()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    got = {r.p: (r.n, r.min_id, r.max_id, r.max_x) for r in layout.footers(spark, f"{folder}/t", ["id", "x"], ("p",)).collect()}
    assert got == {0: (334, 0, 999, 499.5), 1: (333, 1, 997, 498.5), 2: (333, 2, 998, 499.0)}


def test_lines_that_do_not_fit(spark, folder):
    lines = ["a,b,c", "1,x,2.5", '2,"y, z",', ",,", "3,x", "4,x,1,more", "five,x,1", "six,x,one", '7,"p,q"', '8,"p,q",1,2', ""]
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/f.csv", "w") as f:
        f.write("\n".join(lines))
    good, bad = T.read_csv_checked(spark, f"{folder}/in", StructType.fromDDL("a int, b string, c double"))
    assert sorted((tuple(r) for r in good.collect()), key=str) == sorted([(1, "x", 2.5), (2, "y, z", None), (None, None, None)], key=str)
    assert {(r.line, r.reason) for r in bad.collect()} == {("3,x", "few"), ("4,x,1,more", "many"), ("five,x,1", "type a"), ("six,x,one", "type a, c"), ('7,"p,q"', "few"), ('8,"p,q",1,2', "many")}
    assert {r.file for r in bad.collect()} == {"f.csv"}


def test_reads_from_a_database_in_ranges(spark, folder):
    url = f"jdbc:derby:{folder}/db;create=true"
    df = spark.createDataFrame([(k, f"v{k}") for k in range(100)] + [(None, "n")], "k int, v string")
    assert T.export_jdbc({"dim_x": df, "dim_none": df.limit(0)}, url) == {"dim_x": "ok", "dim_none": "ok"}
    got = T.import_jdbc(spark, url, "dim_x", "k", 4)
    assert got.rdd.getNumPartitions() == 4 and sorted(r.v for r in got.collect()) == sorted(r.v for r in df.collect())
    assert T.import_jdbc(spark, url, "dim_none", "k", 4).count() == 0


def test_health_keeps_every_batch(spark, folder):
    log = health.HealthLog(spark, f"{folder}/health", group=3)
    spark.streams.addListener(log)
    try:
        for k in range(4):
            spark.createDataFrame([(k, f"2024-01-01 00:00:0{k}")], "id long, s string").select("id", F.to_timestamp("s").alias("ts")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        s = health.observed(ingest.file_source(spark, f"{folder}/in", "id long, ts timestamp", 1), "ts", ids=F.sum("id"))
        s.writeStream.format("noop").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
        assert log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
    got = health.health(spark, f"{folder}/health").orderBy("batch").collect()
    assert [(r.batch, r.rows, r.facts["ids"], r.status) for r in got] == [(k, 1, str(k), "warn") for k in range(4)]  # the events are of years ago
    assert all(r.seconds > 0 and r.lag_s > 1e7 for r in got)
    assert {r.status for r in health.health(spark, f"{folder}/health", max_lag_s=1e12).collect()} == {"ok"}


def test_slopes_equal_least_squares(spark):
    r = random.Random(2)
    series = {m: sorted((d, r.gauss(5, 2) + (0.8 * d if d > 30 else 0)) for d in r.sample(range(60), 45)) for m in "xy"}
    rows = [(m, d, v) for m, own in series.items() for d, v in own]
    df = spark.createDataFrame(rows, "m string, d int, v double").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    got = {(x.m, x.d): x.slope for x in windows.slopes(df, ["m"], "day", "v").collect()}
    want, alerts = {}, {}
    for m, own in series.items():
        for d, _ in own:
            near = [(e, v) for e, v in own if d - 7 < e <= d]
            want[m, d] = float(np.polyfit(*zip(*near), 1)[0]) if len(near) >= 3 else None
        for d, _ in own:
            past = [want[m, e] for e, _ in own if d - 30 <= e < d and want[m, e] is not None]
            if want[m, d] is not None and len(past) >= 5:
                z = (want[m, d] - np.mean(past)) / np.std(past, ddof=1)
                if abs(z) > 2:
                    alerts[m, d] = z
    assert got.keys() == want.keys() and all((a := got[k]) is None and b is None or abs(a - b) < 1e-9 for k, b in want.items())
    found = {(x.m, x.d): x.z_score for x in windows.trend_deviations(df, ["m"], "day", "v").collect()}
    assert alerts and found.keys() == alerts.keys() and all(abs(found[k] - z) < 1e-6 for k, z in alerts.items())


def test_streamed_sessions_equal_those_of_the_batch(spark, folder):
    """Rows exactly a gap apart are one session; a late row joins two."""
    parts = [[("a", 0), ("a", 600), ("b", 50)], [("a", 3000), ("b", 651)], [("a", 1200), ("a", 1800), ("a", 2400), (None, 999_999)]]
    make = lambda rows: spark.createDataFrame(rows, "u string, s long").select("u", F.timestamp_seconds("s").alias("ts"))
    for p in parts:
        make(p).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    s = ingest.stream_sessions(ingest.file_source(spark, f"{folder}/in", "u string, ts timestamp", 1), ["u"], "ts", 600, "1 day")
    ingest.append_stream(s, f"{folder}/out", f"{folder}/cp", partition_by=()).awaitTermination()
    show = lambda df: sorted((r.u, r.session_start, r.session_end, r.n) for r in df.filter("u IS NOT NULL").collect())
    got = show(spark.read.parquet(f"{folder}/out"))
    assert got == show(windows.sessions(make([x for p in parts for x in p]), ["u"], "ts", 600)) and [x[3] for x in got] == [6, 1, 1]


def test_patients_before_there_is_a_bridge(spark):
    d = spark.createDataFrame([("M2", "A@b.c ", 1980), ("M1", "a@b.c", None), ("M3", None, 1990), ("M4", "x@y.z", None)], "patient_id string, patient_email string, patient_birth_year int")
    got = dims.dim_patient_of_ehr(d, 2024).collect()
    assert sorted(r.age_group for r in got) == ["Unknown", "Unknown"] and len({r.patient_key for r in got}) == 2
