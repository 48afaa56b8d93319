from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.operators import checks, windows
from pulsegrid.sources import adapter
from pulsegrid.sources import tables as T
from pulsegrid.streaming import ingest

from .conftest import SF


def split_events(spark, folder, n=3):
    events = adapter.load(spark, SF, "events")
    for k in range(n):
        events.filter(F.col("event_id") % n == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return events, ingest.file_source(spark, f"{folder}/in", events.schema, 1)


def test_drain_is_exactly_once(spark, folder):
    events, stream = split_events(spark, folder)
    for _ in range(2):  # a second run finds nothing new
        q = ingest.append_stream(T.to_bronze(adapter.event_messages(stream), F.col("timestamp")), f"{folder}/bronze", f"{folder}/cp")
        q.awaitTermination()
    got = spark.read.parquet(f"{folder}/bronze")
    assert got.count() == adapter.bronze(events).count() and set(T.BRONZE_COLUMNS) == set(got.columns)
    report = checks.stream_health(spark, [{"batchId": 0, "batchDuration": 31000, "numInputRows": 5}, {"batchId": 1, "batchDuration": 10, "numInputRows": 5, "timestamp": "2024-01-01T00:10:00.000Z", "eventTime": {"max": "2024-01-01T00:00:00.000Z"}}])
    assert [(r.status, r.lag_s) for r in report.orderBy("batch").collect()] == [("warn", None), ("warn", 600.0)]


def test_stream_upsert_equals_batch(spark, folder):
    events, stream = split_events(spark, folder)
    for _ in range(2):  # a second run finds nothing new
        ingest.upsert_stream(T.to_bronze(adapter.event_messages(stream), F.col("timestamp")), adapter.to_silver, f"{folder}/silver", f"{folder}/cp").awaitTermination()
    assert {r.batch for r in spark.read.parquet(f"{folder}/silver").select("batch").distinct().collect()} == {0, 1, 2}
    got = ingest.first_arrivals(spark, f"{folder}/silver", ["reading_id", "metric_name"], "sync_timestamp", "ingestion_timestamp").drop("batch")
    batch = adapter.to_silver(adapter.bronze(events)).select(got.columns)
    assert got.exceptAll(batch).isEmpty() and got.count() == batch.count()


def test_a_batch_later_than_two_days_is_flagged_and_kept(spark, folder):
    from pulsegrid.operators import quality

    rows = [("a", "m", 1.0, "2024-01-01 00:00:00", "2024-01-01 00:10:00"), ("a", "m", 1.0, "2024-01-01 00:00:00", "2024-01-04 00:00:00"), ("b", "m", 2.0, "2024-01-01 00:00:00", "2024-01-03 00:00:01")]
    for k, part in enumerate((rows[1:2], rows[2:], rows[:1])):  # the late copy comes first
        spark.createDataFrame(part, "k string, m string, v double, e string, s string").selectExpr("k", "m", "v", "timestamp(e) AS event_timestamp", "timestamp(s) AS sync_timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    s = ingest.file_source(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, 1)
    flag = lambda df: quality.flag_late(df, seconds=quality.VERY_LATE_SECONDS, name="very_late")
    ingest.upsert_stream(s, flag, f"{folder}/out", f"{folder}/cp").awaitTermination()
    first = ingest.first_arrivals(spark, f"{folder}/out", ["k", "m"], "sync_timestamp")
    assert sorted((r.k, r.very_late) for r in first.collect()) == [("a", False), ("b", True)]
    assert sorted((r.k, r.very_late) for r in ingest.last_arrivals(spark, f"{folder}/out", ["k", "m"]).collect()) == [("a", False), ("b", True)]


def test_buffer_forgets_after_its_days():
    import pandas as pd

    class State:
        def __init__(self):
            self.d = {}

        def exists(self):
            return bool(self.d)

        def iterator(self):
            return iter(list(self.d.items()))

        def updateValue(self, k, v):
            self.d[k] = v

        def removeKey(self, k):
            del self.d[k]

    def feed(b, values):
        f = pd.DataFrame([(k * 86400, k, v) for k, v in values], columns=["event_s", "seq", "value"])
        return [r.seq for out in b.handleInputRows(("a", "m"), iter([f]), None) for r in out.itertuples()]

    b = ingest.Baseline(least=3, days=30)
    b.state = State()
    assert feed(b, [(k, 10.0 + k % 2) for k in range(10)]) == []
    assert feed(b, [(12, 50.0)]) == [12]
    assert feed(b, [(50, 50.0)]) == [] and set(b.state.d) == {(50,)}  # nothing of the days before is left to judge by
    assert feed(b, [(45, 50.0), (10, 50.0)]) == [] and set(b.state.d) == {(50,), (45,)}


def test_stateful_baseline_equals_running_statistics(spark, folder):
    events, stream = split_events(spark, folder, 2)
    # each file holds later events than the one before
    shaped = lambda df: df.select(F.col("user_id").cast("string").alias("account"), F.col("event_type").alias("metric"), F.col("event_id").alias("seq"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("event_s"), "value")
    for k, p in enumerate(("event_id < 500", "event_id >= 500")):
        events.filter(p).coalesce(1).write.parquet(f"{folder}/o/{k}")
    out = []
    s = ingest.file_source(spark, f"{folder}/o/*", events.schema, 1)
    before = spark.conf.get(ingest.EMPTY_BATCHES)
    q = ingest.alert_stream(ingest.baseline_alerts(shaped(s), least=3), lambda df, _: out.extend(df.collect()), f"{folder}/cp2")
    assert q.awaitTermination(120), "the drain doesn't stop"
    assert spark.conf.get(ingest.EMPTY_BATCHES) == before
    w = windows.Window.partitionBy("account", "metric").orderBy("event_s", "seq").rowsBetween(windows.Window.unboundedPreceding, -1)
    ref = shaped(events).withColumn("n", F.count("*").over(w)).withColumn("m", F.avg("value").over(w)).withColumn("sd", F.stddev_samp("value").over(w))
    want = {(r.account, r.metric, r.seq) for r in ref.filter("n >= 3 AND sd > 0 AND abs(value - m) > 2 * sd").collect()}
    assert {(r.account, r.metric, r.seq) for r in out} == want and want


def brute_force(held, rows, sigma, least, days):
    """Alerts of rows (key, second, seq, value) of a batch, in their order, and the values held of each key's days."""
    import statistics

    alerts = []
    for key, at, seq, value in sorted(rows):
        own, day = held.setdefault(key, {}), at // 86400
        newest = max([day, *own])
        for k in [k for k in own if k <= newest - days]:
            del own[k]
        before = [v for k in own for v in own[k]]
        if len(before) >= max(least, 2) and statistics.stdev(before) > 0 and abs(value - statistics.mean(before)) > sigma * statistics.stdev(before):
            alerts.append((key, seq, statistics.mean(before), statistics.stdev(before)))
        if day > newest - days:
            own.setdefault(day, []).append(value)
    return alerts


def test_bucket_of_keys_equals_brute_force():
    """Keys of one bucket in several batches: late days, days that fall out, idle keys, a key whose values dwarf the others'."""
    import random

    import pandas as pd

    class State:
        value, now = None, 0

        @property
        def getOption(self):
            return self.value

        def update(self, value):
            self.value = value

        def getCurrentProcessingTimeMs(self):
            return self.now

    r, b, state = random.Random(5), ingest.Baseline(least=3, days=4, ttl_ms=5000), State()
    held, last, seq, found = {}, {}, 0, 0
    for batch in range(25):
        state.now, rows = batch * 1000, []
        for key in r.sample([k for k in range(12) if batch < 12 or k != 3], r.randint(1, 8)):
            for _ in range(r.randint(1, 9)):
                seq += 1
                rows.append((key, 86400 * (batch // 2 + r.randint(0, 6 if key % 3 else 2)) + r.randint(0, 86399), seq, 10.0 ** (9 if key == 5 else 0) * (r.choice([10, 11, 12, 40]) + key)))
        seen = {k for k, *_ in rows}
        for k in seen:
            if batch - last.get(k, batch) >= 5:
                del held[k]
        last |= dict.fromkeys(seen, batch)
        want = sorted(brute_force(held, rows, 2.0, 3, 4))
        f = pd.DataFrame([(str(k) if k else None, "m", s, t, v) for k, t, s, v in rows], columns=["account", "metric", "seq", "event_s", "value"])
        got = sorted((int(x.account or 0), x.seq, x.mean, x.std) for out in b.of_bucket((0,), iter([f]), state) for x in out.itertuples())
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert all(abs(p - q) <= 1e-9 * abs(q) for x, y in zip(got, want) for p, q in zip(x[2:], y[2:]))
        found += len(got)
    assert found > 20 and "3" not in state.value[0]


def test_alerts_of_many_keys_have_few_states(spark, folder):
    """A batch calls Python once for a bucket; a state of each key's day took minutes for some thousand keys."""
    keys = spark.range(3000).selectExpr("cast(id % 1000 AS string) AS account", "'m' AS metric", "id AS seq", "id div 1000 * 86400 AS event_s", "cast(if(id >= 2000 AND id % 7 = 0, 50, id div 1000 % 2) AS double) AS value")
    keys.write.parquet(f"{folder}/in")
    out = []
    q = ingest.alert_stream(ingest.baseline_alerts(ingest.file_source(spark, f"{folder}/in", keys.schema), least=2, buckets=16), lambda df, _: out.extend(df.collect()), f"{folder}/cp")
    assert q.awaitTermination(120)
    assert sorted(r.seq for r in out) == [k for k in range(2000, 3000) if k % 7 == 0]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 16
