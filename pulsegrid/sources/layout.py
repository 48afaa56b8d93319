"""File layout: clustering by a space-filling curve, and what Parquet footers tell without reading a column.

Footers are read by Spark: its V2 Parquet source answers counts, minima and maxima of whole numbers, floats and dates from
them, by partition column where asked. A clustered table has a partition column `cell` with a file for each value, so these
are the statistics of single files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import settings

from .tables import shared_folder

#: Ranks of a key are told apart in 2 ** BITS classes.
BITS = 6
FOOTERS_ONLY = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


def _class_of(value: Column, cuts: list[float], bits: int) -> Column:
    """How many of the cuts the value has reached, stretched to the whole range of the bits, so that a key of few values weighs as much as another; 0 for a null."""
    if not cuts:
        return F.lit(0).cast("long")
    reached = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= value))
    return F.coalesce(F.when(value.isNotNull(), F.floor(reached * (1 << bits) / (len(cuts) + 1))), F.lit(0)).cast("long")


def z_value(df: DataFrame, keys: list[str], bits: int = BITS) -> Column:
    """The place of a row on the curve: the bits of its keys' rank classes in turn, so that near places are near in every key. Classes are cut at quantiles, at most 2 ** bits - 1 of each key; nulls are in the first one."""
    cuts = df.select(*[F.col(k).cast("double").alias(k) for k in keys]).approxQuantile(keys, [i / (1 << bits) for i in range(1, 1 << bits)], 1 / (1 << bits + 2))
    z = F.lit(0).cast("long")
    for at, (key, own) in enumerate(zip(keys, cuts, strict=True)):
        rank = _class_of(F.col(key).cast("double"), sorted(set(own)), bits)
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(keys) + at))
    return z


def write_clustered(df: DataFrame, path: str, keys: list[str], files: int, curve: bool = True) -> None:
    """df at path in so many files, of ranges of the curve over the keys, or, without it, of ranges of their linear order."""
    ranged = df.withColumn("_z", z_value(df, keys)).repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z") if curve else df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    ranged.withColumn("cell", F.spark_partition_id()).write.mode("overwrite").partitionBy("cell").parquet(path)


def footer_query(spark: SparkSession, path: str, columns: list[str], by: list[str]) -> DataFrame:
    """by, n, and min_ and max_ of each column; answered from footers if it is made and run under FOOTERS_ONLY."""
    values = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return spark.read.parquet(path).groupBy(*by).agg(F.count("*").alias("n"), *values)


def footers(spark: SparkSession, path: str, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """The same, stored in the shared folder. An empty table has a row of nulls with a count of 0, or none if it is asked by partition."""
    out = shared_folder(spark)
    with settings(spark, FOOTERS_ONLY):
        footer_query(spark, path, columns, list(by)).write.parquet(out)
    return spark.read.parquet(out)


def cells_within(stats: DataFrame, bounds: dict[str, tuple[float, float]]) -> list[int]:
    """The files of a clustered table that can hold rows within all bounds; a list of at most the table's files."""
    for c, (low, high) in bounds.items():
        stats = stats.filter((F.col(f"max_{c}") >= low) & (F.col(f"min_{c}") <= high))
    return sorted(r.cell for r in stats.select("cell").collect())


def read_within(spark: SparkSession, path: str, bounds: dict[str, tuple[float, float]]) -> tuple[DataFrame, int, int]:
    """The rows within the bounds, the files that are opened for them, and all files."""
    stats = footers(spark, path, list(bounds), ("cell",))
    cells = cells_within(stats, bounds)
    rows = spark.read.parquet(path).filter(F.col("cell").isin(cells))
    for c, (low, high) in bounds.items():
        rows = rows.filter(F.col(c).between(low, high))
    return rows.drop("cell"), len(cells), stats.count()


def footer_freshness(spark: SparkSession, tables: dict[str, tuple[str, str]], sla_hours: dict[str, int], now_s: float) -> DataFrame:
    """(table, rows, hours, sla_hours, status) as `tables.freshness` has it, from footers alone; each table has a path and a column of seconds."""
    rows = []
    for name, (path, column) in tables.items():
        r = footers(spark, path, [column]).first()
        newest = r[f"max_{column}"]
        hours = None if newest is None else (now_s - newest) / 3600
        rows.append((name, r.n, hours, sla_hours[name], "ok" if hours is not None and hours <= sla_hours[name] else "stale"))
    return spark.createDataFrame(rows, "table string, rows long, hours double, sla_hours int, status string")
