"""A bounded, repeatable sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, label: Column, key: Column, per_class: int) -> DataFrame:
    """(text, label): of each label at most `per_class` rows, those with the least hash of `key`. Where the labels are a table of their own, `text` can be its ids, as strings.

    Rows without label, text or key are never taken. Labels are few: their counts come to the driver. A threshold on the
    hash leaves about three times as many rows as are wanted before any is ranked, so no large group is gathered.
    """
    df = docs.select(F.col("text").cast("string").alias("text"), label.alias("label"), F.xxhash64(key.cast("string")).alias("h"), key.isNotNull().alias("has_key"))
    df = df.filter("has_key AND label IS NOT NULL AND text IS NOT NULL AND text <> ''").drop("has_key")
    counts = df.groupBy("label").count().collect()
    if not counts:
        return df.select("text", "label").limit(0)
    limit = F.lit(0.0)
    for row in counts:
        limit = F.when(F.col("label") == F.lit(row["label"]), min(1.0, 3.0 * per_class / row["count"] + 1e-4)).otherwise(limit)
    near = df.filter(F.pmod("h", F.lit(1_000_003)) <= limit * 1_000_003)
    order = Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1_000_003)), "h", F.sha2("text", 256))
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_class).select("text", "label")
