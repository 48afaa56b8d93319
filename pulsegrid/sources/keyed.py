"""Keyed Parquet tables: upserts that rewrite only the partitions they touch, replay into them, folded batch folders.

A keyed table has one row for each key: of all that were merged into it the first, or the last, in a stated order. It lies
in hash buckets of the key, below partition columns that the key determines (such as its day), so a key is always in the
same partition, and every partition is one file. A merge reads and rewrites the partitions of its source's keys alone.
Every source has the table's columns.

Merges are safe to repeat. The new partitions are written aside first and then moved, one by one, into the place of the old
ones; a run that was cut short after the writing ends the moving when it is repeated with the same step, and one that is
repeated whole merges rows that are there already.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.scd import erase

class Files:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.of(path), True)

    def move(self, source: str, target: str) -> None:
        """Puts source in the place of target."""
        self.delete(target)
        self.fs.mkdirs(self.of(target).getParent())
        if not self.fs.rename(self.of(source), self.of(target)):
            raise OSError(f"could not move {source} to {target}")

    def folders(self, path: str) -> list[str]:
        return sorted(str(s.getPath().getName()) for s in self.fs.listStatus(self.of(path)) if s.isDirectory()) if self.exists(path) else []


def bucket_name(buckets: int) -> str:
    """The name of the bucket column; it tells their number, so that a table can't be merged with another one."""
    return f"bucket_of_{buckets}"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def one_of_each(df: DataFrame, keys: list[str], order: list[str], latest: bool = False) -> DataFrame:
    """The first row of each key in the order, nulls last (or the last one, nulls first); rows that are combined before the shuffle, so a frequent key is no task's burden."""
    rest = [c for c in df.columns if c not in keys]
    by = [x for c in order for x in (F.col(c).isNotNull() if latest else F.col(c).isNull(), F.col(c))]
    pick = F.max_by if latest else F.min_by
    # the hash makes the choice between rows that are equal in the order one of their values
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*by, F.xxhash64(*rest))).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def partitions_of(df: DataFrame, parts: list[str]) -> tuple[Column, int]:
    """Whether a row lies in one of df's partitions, as a condition on partition columns only, and their number. The list is bounded by the table's partitions."""
    rows = df.select(*parts).distinct().collect()
    inner: dict[tuple, list] = {}
    for r in rows:
        inner.setdefault(tuple(r)[:-1], []).append(r[-1])
    tests = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(parts, outer)] + [F.col(parts[-1]).isin(own)]) for outer, own in inner.items()]
    return reduce(Column.__or__, tests, F.lit(False)), len(rows)


def merge_into(path: str, source: DataFrame, keys: list[str], order: list[str], step: str, buckets: int = 64, parts: tuple[str, ...] = (), latest: bool = False) -> int:
    """Merges source into the table at path, or makes it, and returns the number of partitions that it rewrote. `step` names the merge: it is the same if the same source is merged again."""
    spark = source.sparkSession
    files, own = Files(spark, path), [*parts, bucket_name(buckets)]
    aside, landed = f"{path}/_aside/{step}", f"{path}/_landed/{step}"
    if not files.exists(f"{aside}/_SUCCESS"):
        # the source is read twice: for its partitions and for its rows
        keyed = source.withColumn(own[-1], bucket_of(keys, buckets))
        keyed.write.mode("overwrite").parquet(landed)
        new = spark.read.schema(keyed.schema).parquet(landed)
        within, count = partitions_of(new, own)
        there = _columns_of(files, path)
        if there and there != own:
            raise ValueError(f"the table at {path} is partitioned by {there}, not by {own}")
        both = spark.read.schema(keyed.schema).parquet(path).filter(within).unionByName(new) if there else new
        one_of_each(both, keys, order, latest).repartition(max(count, 1), *own).write.mode("overwrite").partitionBy(*own).parquet(aside)
    moved = list(_leaves(files, aside, len(own)))
    for leaf in moved:
        files.move(f"{aside}/{leaf}", f"{path}/{leaf}")
    files.delete(aside)
    files.delete(landed)
    return len(moved)


def _columns_of(files: Files, path: str) -> list[str]:
    """The partition columns of the table at path, by its first folders; none if there is no table."""
    names = [n for n in files.folders(path) if "=" in n]
    return [names[0].split("=")[0], *_columns_of(files, f"{path}/{names[0]}")] if names else []


def _leaves(files: Files, path: str, depth: int) -> list[str]:
    names = [n for n in files.folders(path) if not n.startswith(("_", "."))]
    return names if depth == 1 else [f"{n}/{leaf}" for n in names for leaf in _leaves(files, f"{path}/{n}", depth - 1)]


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table, without the bucket."""
    df = spark.read.parquet(path)
    return df.drop(*[c for c in df.columns if c.startswith("bucket_of_")])


def replay_into(spark: SparkSession, bronze: str, since: str, transform: Callable[[DataFrame], DataFrame], path: str, keys: list[str], order: list[str], **how) -> int:
    """Bronze partitions from the date on, transformed and merged into the table at path; only these are read, only the partitions of their keys are rewritten."""
    rows = transform(spark.read.parquet(bronze).filter(F.col("ingestion_date") >= since))
    return merge_into(path, rows, keys, order, f"replay-{since}", **how)


def fold_batches(spark: SparkSession, batches: str, path: str, keys: list[str], order: list[str], **how) -> int:
    """Merges the batch folders that `streaming.ingest.upsert_stream` has written so far into the table at path and removes them; returns their number. Of rows that the order leaves equal the earlier batch's is first."""
    files = Files(spark, batches)
    numbers = sorted(int(n.removeprefix("batch=")) for n in files.folders(batches) if n.startswith("batch="))
    if numbers:
        # a table that earlier batches were folded into has their numbers too
        rows = spark.read.option("basePath", batches).parquet(*[f"{batches}/batch={n}" for n in numbers])
        merge_into(path, rows.withColumn("batch", F.col("batch").cast("long")), keys, [*order, "batch"], f"fold-{numbers[0]}-{numbers[-1]}", **how)
        for n in numbers:
            files.delete(f"{batches}/batch={n}")
    return len(numbers)


def erase_in(path: str, people: DataFrame, key: str, columns: list[str], parts: list[str], step: str) -> tuple[int, int]:
    """Right to erasure in the Parquet table at path, with partition columns parts: the named columns of the listed people become null, the rows stay.

    The files that hold any of them are found by reading the key alone; only their partitions are rewritten. Returns the
    files that were found and the partitions that were rewritten.
    """
    spark = people.sparkSession
    df = spark.read.parquet(path)
    of = people.select(F.col(key).alias("_gone")).distinct()
    found = df.select(key, *parts, F.col("_metadata.file_path").alias("_file")).join(of, F.col(key) == F.col("_gone"), "left_semi").select(*parts, "_file").distinct()
    hits = found.groupBy(*parts).agg(F.count("*").alias("files"))
    within, count = partitions_of(hits, parts)
    if not count:
        return 0, 0
    files = hits.agg(F.sum("files")).first()[0]
    return files, rewrite_partitions(path, erase(df.filter(within), people, key, columns), parts, step)


def rewrite_partitions(path: str, rows: DataFrame, parts: list[str], step: str) -> int:
    """Puts rows, all that the partitions they lie in shall have, in the place of these partitions of the Parquet table at path, one file each."""
    spark = rows.sparkSession
    files, aside = Files(spark, path), f"{path}/_aside/{step}"
    if not files.exists(f"{aside}/_SUCCESS"):
        rows.repartition(*parts).write.mode("overwrite").partitionBy(*parts).parquet(aside)
    moved = _leaves(files, aside, len(parts))
    for leaf in moved:
        files.move(f"{aside}/{leaf}", f"{path}/{leaf}")
    files.delete(aside)
    return len(moved)
