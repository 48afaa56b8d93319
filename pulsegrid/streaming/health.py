"""The health of streams as a table: rows, lag, duration and status of every batch, kept by a listener.

A query keeps the progress of its last 100 batches only; the listener hears of each and appends it to a Parquet table in
groups, whatever becomes of the query. What only the rows know, such as their newest event, comes from metrics that the
stream observes as it runs, without a pass of its own.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from pulsegrid.sources.keyed import one_of_each

#: The name of the observed metrics.
METRICS = "health"
LOG = "query string, run string, batch long, rows long, newest_s double, at_s double, seconds double, facts map<string,string>"
#: A batch is late beyond this lag, and slow beyond this duration, in seconds.
MAX_LAG_S, MAX_BATCH_S = 300.0, 30.0


def observed(df: DataFrame, ts: str, **facts: Column) -> DataFrame:
    """df, with its newest event and other aggregates as observed metrics."""
    return df.observe(METRICS, F.max(F.unix_micros(ts) / 1e6).alias("newest_s"), *[c.alias(k) for k, c in facts.items()])


def by_the_clock(progress: object, metrics: dict) -> tuple[float, float]:
    """(when the batch started, how long it took) in seconds, as Spark reports them."""
    return datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp(), progress.batchDuration / 1000


class HealthLog(StreamingQueryListener):
    """Appends every batch that had rows to the table at path, `group` batches at a time and the rest as a query ends.

    If the driver is lost, up to group - 1 batches are missing from the table. `measure` gives a batch's start and duration
    from its progress and metrics. `ended` is set when a query has ended and all is written.
    """

    def __init__(self, spark: SparkSession, path: str, group: int = 20, measure: Callable[[object, dict], tuple[float, float]] = by_the_clock) -> None:
        self.spark, self.path, self.group, self.measure = spark, path, group, measure
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event: object) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: object) -> None:
        p = event.progress
        if p.numInputRows:
            seen = p.observedMetrics.get(METRICS)
            metrics = seen.asDict() if seen else {}
            at, seconds = self.measure(p, metrics)
            newest = metrics.get("newest_s")
            facts = {k: str(v) for k, v in metrics.items() if k != "newest_s" and v is not None}
            self.rows.append((str(p.id), str(p.runId), int(p.batchId), int(p.numInputRows), newest, float(at), float(seconds), facts))
            if len(self.rows) >= self.group:
                self.write()

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        self.write()
        self.ended.set()

    def write(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, LOG).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []


def health(spark: SparkSession, path: str, max_lag_s: float = MAX_LAG_S, max_batch_s: float = MAX_BATCH_S) -> DataFrame:
    """Per batch: query, batch, rows, lag_s (its start less its newest event), seconds, status and facts. Of a batch that ran again the last run counts; lag is null where no event was observed."""
    df = one_of_each(spark.read.schema(LOG).parquet(path).withColumn("_facts", F.to_json("facts")).drop("facts"), ["query", "batch"], ["at_s"], latest=True)
    lag = F.col("at_s") - F.col("newest_s")
    slow = (F.col("seconds") > max_batch_s) | F.coalesce(lag > max_lag_s, F.lit(False))
    return df.select("query", "batch", "rows", lag.alias("lag_s"), "seconds", F.when(slow, "warn").otherwise("ok").alias("status"), F.from_json("_facts", "map<string,string>").alias("facts"))
