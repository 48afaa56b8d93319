"""Streams: broker or file sources, append sinks, idempotent upserts by micro-batch, and a stateful personal baseline."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from pulsegrid.operators.windows import keep_first, keep_latest
from pulsegrid.session import settings
from pulsegrid.sources.keyed import merge_into
from pulsegrid.sources.tables import to_bronze


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Needs the broker connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "false").load()


def file_source(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet files, or a pattern, as a stream; so bronze written by batches joins a stream."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).parquet(path)


def append_stream(df: DataFrame, path: str, checkpoint: str, every: str | None = None, partition_by: tuple[str, ...] = ("ingestion_date", "ingestion_hour")) -> StreamingQuery:
    """Append sink: micro-batches `every` interval, or all that is there and then stop. The checkpoint makes it exactly-once."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def bronze_stream(messages: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    return append_stream(to_bronze(messages), path, checkpoint, every)


def upsert_stream(df: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each micro-batch is transformed and written as its own partition; a batch that is run again replaces its own rows. Nothing that was there is rewritten: `first_arrivals` and `last_arrivals` merge on reading."""

    def step(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    w = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def first_arrivals(spark: SparkSession, path: str, keys: list[str], *order: str) -> DataFrame:
    """The table that `upsert_stream` wrote, the first row of each key in the order, then of the earliest batch."""
    return keep_first(spark.read.parquet(path), keys, *order, "batch")


def last_arrivals(spark: SparkSession, path: str, keys: list[str], *order: str) -> DataFrame:
    """The same with the last row of each key, of the latest batch first."""
    return keep_latest(spark.read.parquet(path), keys, "batch", *order)


def keyed_stream(df: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: list[str], order: list[str], every: str | None = None, **how) -> StreamingQuery:
    """Each micro-batch is transformed and merged into the keyed table at path (`sources.keyed`), which has the first row of each key in the order: a read opens one file a partition however many batches there were. A batch that is run again changes nothing."""

    def step(batch: DataFrame, number: int) -> None:
        merge_into(path, transform(batch), keys, order, f"batch-{number}", **how)

    w = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def stream_sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int, delay: str) -> DataFrame:
    """keys, session_start, session_end, n as a stream: the sessions of `operators.windows.sessions`, each given out once the watermark, which is `delay` behind the newest row, has passed its gap. Rows may come in any order within the delay; sessions that they connect become one."""
    # a session ends a gap after its last row, and a row at that very moment still belongs to it
    own = F.session_window(ts, f"{gap_seconds} seconds")
    by = df.withWatermark(ts, delay).groupBy(*keys, own.alias("_session"))
    return by.agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("n")).select(*keys, "session_start", "session_end", "n")


#: Statistics of a key's day: the key's number, the day since 1970, count, mean and squared deviations.
DAYS = np.dtype([("key", "i8"), ("day", "i8"), ("n", "i8"), ("mean", "f8"), ("m2", "f8")])


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, i) for all i of low[k]..high[k] - 1."""
    size = high - low
    return np.repeat(np.arange(len(size)), size), np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


def _merged(group: np.ndarray, parts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and squared deviations of so many groups of parts, a mean of 0 for an empty one."""
    n = np.bincount(group, parts["n"], groups)
    mean = np.bincount(group, parts["n"] * parts["mean"], groups) / np.maximum(n, 1)
    return n, mean, np.bincount(group, parts["m2"] + parts["n"] * (parts["mean"] - mean[group]) ** 2, groups)


class Baseline(StatefulProcessor):
    """Statistics of each key by day, of the trailing `days` days; a reading beyond sigma deviations of those before it is an alert.

    The buffer has a row of count, mean and squared deviations for each day, so it is bounded whatever a day's readings are,
    and a day's readings of a batch are judged at once, by running sums of their deviations.
    Days that fall out are removed, idle keys expire. Readings of a batch are taken in the order of their time; one from
    before the newest day counts for its own day, if that is still in the buffer, and is judged as of the newest one.

    The state is of one key, a map of its days (`handleInputRows`), or of a bucket of keys (`of_bucket`).
    """

    def __init__(self, sigma: float = 2.0, least: int = 5, days: int = 30, ttl_ms: int = 90 * 86400 * 1000) -> None:
        self.sigma, self.least, self.days, self.ttl_ms = sigma, least, days, ttl_ms

    def judged(self, held: np.ndarray, key: np.ndarray, frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """The alerts of the rows (event_s, seq, value), each of the key of the given number, and what is held afterwards.

        Each key's readings of a day are one part, judged by all parts within the days before it, those of the batch included.
        """
        frame = frame.assign(key=key).sort_values(["key", "event_s", "seq"], kind="stable", ignore_index=True)
        code = lambda key, day: key * (1 << 40) + day
        held = held[np.argsort(code(held["key"], held["day"]))]
        key, value, day = frame["key"].to_numpy(), frame["value"].to_numpy(float), frame["event_s"].to_numpy() // 86400
        start = np.flatnonzero(np.append(True, np.diff(code(key, day)) != 0)) if len(frame) else np.zeros(0, int)
        size, part = np.diff(np.append(start, len(frame))), np.zeros(len(start), DAYS)
        of = np.repeat(np.arange(len(start)), size)
        part["key"], part["day"], part["n"] = key[start], day[start], size
        if len(part):
            part["mean"] = np.add.reduceat(value, start) / size
            part["m2"] = np.add.reduceat((value - part["mean"][of]) ** 2, start)
        have, own = code(held["key"], held["day"]), code(part["key"], part["day"])
        end = np.searchsorted(have, code(part["key"] + 1, -(1 << 39)))
        newest = np.maximum(part["day"], np.where(end > np.searchsorted(have, code(part["key"], -(1 << 39))), held["day"][end - 1] if len(held) else 0, part["day"]))
        counts, out = part["day"] > newest - self.days, code(part["key"], newest - self.days)
        a, x = _spans(np.searchsorted(have, out, "right"), end)
        b, y = _spans(np.minimum(np.searchsorted(own, out, "right"), np.arange(len(part))), np.arange(len(part)))
        b, y = b[counts[y]], y[counts[y]]
        n, mean, m2 = _merged(np.append(a, b), np.append(held[x], part[y]), len(part))
        # the deviations from the mean so far of the day's readings before each one; none count of a day that is out of the buffer
        mean = np.where(n > 0, mean, value[start])
        d = (value - mean[of]) * counts[of]
        sums = pd.DataFrame({"of": of, "d": d, "d2": d * d}).groupby("of", sort=False).cumsum()
        first, second = sums["d"].to_numpy() - d, sums["d2"].to_numpy() - d * d
        before = n[of] + (np.arange(len(of)) - start[of]) * counts[of]
        with np.errstate(divide="ignore", invalid="ignore"):
            centre = mean[of] + first / before
            std = np.sqrt(np.maximum(m2[of] + second - first * first / before, 0.0) / (before - 1))
            far = (before >= max(self.least, 2)) & (std > 0) & (np.abs(value - centre) > self.sigma * std)
        alerts = pd.DataFrame({"key": key[far], "seq": frame["seq"].to_numpy()[far], "value": value[far], "mean": centre[far], "std": std[far]})
        parts = np.append(held, part[counts])
        codes, to = np.unique(code(parts["key"], parts["day"]), return_inverse=True)
        now = np.zeros(len(codes), DAYS)
        now["key"][to], now["day"][to] = parts["key"], parts["day"]
        now["n"], now["mean"], now["m2"] = _merged(to, parts, len(codes))
        last = now["day"][np.searchsorted(codes, code(now["key"] + 1, -(1 << 39))) - 1] if len(now) else now["day"]
        return alerts, now[now["day"] > last - self.days]

    def of_bucket(self, bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The alerts of a bucket's rows (account, metric, seq, event_s, value). Its keys, when they last had rows, and their days are one state, so a batch reads and writes it once."""
        now = state.getCurrentProcessingTimeMs()
        account, metric, seen, held = state.getOption or ([], [], [], b"")
        held, seen = np.frombuffer(bytes(held), DAYS), np.array(seen, np.int64)
        live = seen > now - self.ttl_ms
        held = held[live[held["key"]]]
        held["key"] = (np.cumsum(live) - 1)[held["key"]]
        index = {k: i for i, k in enumerate(k for k, lives in zip(zip(account, metric), live) if lives)}
        frame = pd.concat(list(frames), ignore_index=True)
        key = np.array([index.setdefault(k, len(index)) for k in zip(frame["account"], frame["metric"])], np.int64)
        seen = np.append(seen[live], np.full(len(index) - live.sum(), now))
        seen[key] = now
        alerts, held = self.judged(held, key, frame[["event_s", "seq", "value"]])
        account, metric = ([k[i] for k in index] for i in (0, 1))
        state.update((account, metric, seen.tolist(), held.tobytes()))
        if len(alerts):
            at = alerts.pop("key")
            alerts.insert(0, "account", [account[i] for i in at])
            alerts.insert(1, "metric", [metric[i] for i in at])
            yield alerts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("days", "day long", "n long, mean double, m2 double", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        old = {k[0]: tuple(v) for k, v in self.state.iterator()} if self.state.exists() else {}
        frame = pd.concat(list(rows))
        held = np.array([(0, day, *x) for day, x in old.items()], DAYS)
        alerts, held = self.judged(held, np.zeros(len(frame), np.int64), frame[["event_s", "seq", "value"]])
        new = {x[1]: x[2:] for x in held.tolist()}
        for day in set(old) - set(new):
            self.state.removeKey((day,))
        for day in new:
            if old.get(day) != new[day]:
                self.state.updateValue((day,), new[day])
        yield alerts.drop(columns="key").assign(account=key[0], metric=key[1])[["account", "metric", "seq", "value", "mean", "std"]]

    def close(self) -> None:
        pass


ALERTS = "account string, metric string, seq long, value double, mean double, std double"
#: The state of a bucket of keys; held has rows of DAYS.
BUCKET = "account array<string>, metric array<string>, seen array<long>, held binary"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def baseline_alerts(readings: DataFrame, sigma: float = 2.0, least: int = 5, days: int = 30, buckets: int = 1024) -> DataFrame:
    """Streaming alerts of readings (account, metric, seq, event_s, value). `alert_stream` sets the RocksDB state store for its query.

    The keys are dealt to buckets, and Python is called once for each of those that a batch has rows of, not for each key. The
    number of buckets belongs to the checkpoint. Idle keys expire when their bucket has rows again.
    """
    dealt = readings.select("account", "metric", "seq", "event_s", "value", F.pmod(F.xxhash64("account", "metric"), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInPandasWithState(Baseline(sigma, least, days).of_bucket, ALERTS, BUCKET, "append", "NoTimeout")


#: Whether a stream runs batches without new rows; where processing time counts, each of these calls for the next one.
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def alert_stream(alerts: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Starts `baseline_alerts`; without `every` it drains the source and stops.

    A drain of a stream with processing-time timers would never stop if it ran batches without rows, so this one runs none.
    Only this query is touched: it takes its settings from the session as it starts.
    """
    with settings(alerts.sparkSession, {EMPTY_BATCHES: "false", "spark.sql.streaming.stateStore.providerClass": ROCKS_DB}):
        w = alerts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).outputMode("append")
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
