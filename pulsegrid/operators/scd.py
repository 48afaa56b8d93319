"""Upserts, change application and history as pure functions: (target, source) -> new target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import keep_latest, keep_one


def _same(keys: list[str], a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def merge_scd1(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Matched rows take the source's columns, others are added. With `order` the source's latest row of a key wins, without it the source must have one row for each key."""
    if order:
        source = keep_latest(source, keys, *order)
    rest = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return rest.select(*target.columns).unionByName(source.select(*target.columns))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows with a new key are added, one for each key: of several the one that sorts first by all columns."""
    new = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return target.unionByName(keep_one(new, keys, *[F.col(c).asc_nulls_last() for c in target.columns]))


def merge_columns(target: DataFrame, source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Matched rows take only the named columns, others are added whole. One row for each key on either side."""
    there, here = F.col("s._in"), F.col("t._in")
    joined = target.withColumn("_in", F.lit(True)).alias("t").join(source.withColumn("_in", F.lit(True)).alias("s"), _same(keys, "t", "s"), "full_outer")
    cols = [F.when(there & (here.isNull() | F.lit(c in update)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return joined.select(*cols)


def merge_scd2(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str = "row_hash", start: str = "effective_start", end: str = "effective_end", current: str = "is_current") -> DataFrame:
    """Closes current versions whose hash differs, at the new version's start, and adds the versions that aren't there.

    source has one row for each key. A version is there if the key has one with the same hash and start, or a current one
    with the same hash; so running it again changes nothing, also for versions that came closed.
    """
    source = source.dropDuplicates([*keys, hash_col, start])
    live = source.groupBy(*keys).agg(F.max(F.struct(F.col(start).alias("s"), F.col(hash_col).alias("h"))).alias("_new"))
    known = target.select(*keys, F.col(hash_col).alias("_h"), F.col(start).alias("_s"), F.col(current).alias("_c"))
    on = [*(F.col(f"s.{k}") == F.col(f"k.{k}") for k in keys), F.col(f"s.{hash_col}") == F.col("k._h"), F.col("k._c") | (F.col(f"s.{start}") == F.col("k._s"))]
    fresh = source.alias("s").join(known.alias("k"), reduce(lambda a, b: a & b, on), "left_anti")
    fresh_keys = fresh.select(*keys).distinct().withColumn("_fresh", F.lit(True))
    t = target.join(live, keys, "left").join(fresh_keys, keys, "left")
    close = F.coalesce(F.col(current) & F.col("_fresh") & (F.col("_new.h") != F.col(hash_col)) & (F.col("_new.s") > F.col(start)), F.lit(False))
    closed = t.withColumn(end, F.when(close, F.col("_new.s")).otherwise(F.col(end))).withColumn(current, F.when(close, F.lit(False)).otherwise(F.col(current)))
    return closed.select(*target.columns).unionByName(fresh.select(*target.columns))


def history(batches: DataFrame, keys: list[str], at: str, hash_col: str, order: list[str], live: Column | None = None) -> DataFrame:
    """Versions from a whole sequence of batches: rows of a key by time (the last of a time by `order`), one version for each change of the hash.

    effective_end is the next version's start. With `live`, a version for which it is false is closed at once: the key
    has no current version until a live one comes.
    """
    df = keep_latest(batches, [*keys, at], *order)
    w = Window.partitionBy(*keys).orderBy(at)
    df = df.withColumn("_before", F.lag(hash_col).over(w)).filter(~F.col(hash_col).eqNullSafe(F.col("_before"))).drop("_before")
    df = df.withColumn("effective_start", F.col(at)).withColumn("effective_end", F.lead(at).over(w))
    current = F.col("effective_end").isNull()
    if live is not None:
        df = df.filter(live)
    return df.withColumn("is_current", current)


def apply_cdc(target: DataFrame, events: DataFrame, keys: list[str], order: list[str], apply_deletes: bool = False, op: str = "op") -> DataFrame:
    """The latest event of each key wins: creates and updates are merged, deletes take the row away if asked to, else are ignored."""
    if not apply_deletes:
        events = events.filter(F.col(op) != "d")
    last = keep_latest(events, keys, *order)
    rest = target.join(last.select(*keys), keys, "left_anti").select(*target.columns)
    return rest.unionByName(last.filter(F.col(op) != "d").select(*target.columns))


def erase(df: DataFrame, people: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Right to erasure: the named columns of the listed people become null, the rows stay."""
    hit = people.select(F.col(key).alias("_gone")).distinct()
    out = df.join(hit, F.col(key) == F.col("_gone"), "left")
    return out.select(*[F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def erasure_sweep(tables: dict[str, DataFrame], people: DataFrame, key: str, columns: dict[str, list[str]]) -> DataFrame:
    """(check, object, value, status): what each personal column of each table still has of the listed people."""
    gone = people.select(F.col(key).alias("_gone")).distinct()
    parts = []
    for name, cols in columns.items():
        left = tables[name].join(gone, F.col(key) == F.col("_gone"), "left_semi").agg(*[F.count(c).alias(c) for c in cols])
        rows = F.explode(F.array(*[F.struct(F.lit(f"{name}.{c}").alias("object"), F.col(c).alias("n")) for c in cols]))
        parts.append(left.select(rows.alias("x")))
    n = F.col("x.n")
    return reduce(DataFrame.unionByName, parts).select(F.lit("erasure").alias("check"), "x.object", n.cast("double").alias("value"), F.when(n == 0, "ok").otherwise("fail").alias("status"))
