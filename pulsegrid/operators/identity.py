"""Identity resolution: pairs, bridge rows, links by rule, fuzzy links and transitive closure."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.keys import person_key
from pulsegrid.sources.tables import shared_folder

from .joins import proximity_join
from .scd import merge_columns

BRIDGE = ["patient_key", "identifier_type", "identifier_value", "source", "link_status", "match_method", "first_seen", "last_seen"]


def ehr_pairs(conditions: DataFrame, medications: DataFrame) -> DataFrame:
    """Distinct (patient_id, patient_email) of either table, with the person key of the e-mail."""
    cols = ["patient_id", "patient_email"]
    both = conditions.select(*cols).unionByName(medications.select(*cols)).filter("patient_id IS NOT NULL AND patient_email IS NOT NULL")
    return both.select("patient_id", F.lower(F.trim("patient_email")).alias("patient_email")).distinct().withColumn("patient_key", person_key("patient_email"))


def bridge_rows(pairs: DataFrame, seen: Column) -> DataFrame:
    """Two identifier rows for each pair."""
    rows = pairs.select("patient_key", F.explode(F.array(F.struct(F.lit("hospital_mrn").alias("identifier_type"), F.col("patient_id").alias("identifier_value")), F.struct(F.lit("email").alias("identifier_type"), F.col("patient_email").alias("identifier_value")))).alias("i")).select("patient_key", "i.*")
    rows = rows.groupBy("identifier_type", "identifier_value").agg(F.min("patient_key").alias("patient_key"))
    return rows.select("patient_key", "identifier_type", "identifier_value", F.lit("ehr").alias("source"), F.lit("linked").alias("link_status"), F.lit("exact_mrn_email").alias("match_method"), seen.alias("first_seen"), seen.alias("last_seen"))


def pending_devices(readings: DataFrame, seen: Column) -> DataFrame:
    """A pending row, without a person, for each device account."""
    df = readings.filter("device_account_id IS NOT NULL").select("device_account_id").distinct()
    return df.select(F.lit(None).cast("string").alias("patient_key"), F.lit("device_account_id").alias("identifier_type"), F.col("device_account_id").alias("identifier_value"), F.lit("wearable").alias("source"), F.lit("pending_registration").alias("link_status"), F.lit(None).cast("string").alias("match_method"), seen.alias("first_seen"), seen.alias("last_seen"))


def link_devices(pending: DataFrame, registry: DataFrame) -> DataFrame:
    """Pending rows linked to the person of the e-mail that the account is registered with: registry has device_account_id and email."""
    r = registry.filter("email IS NOT NULL").groupBy(F.col("device_account_id").alias("identifier_value")).agg(F.min(F.lower(F.trim("email"))).alias("_email"))
    df = pending.join(r, "identifier_value", "left")
    hit = F.col("_email").isNotNull()
    df = df.withColumn("patient_key", F.when(hit, person_key("_email")).otherwise(F.col("patient_key"))).withColumn("link_status", F.when(hit, "linked").otherwise(F.col("link_status"))).withColumn("match_method", F.when(hit, "registry_email").otherwise(F.col("match_method")))
    return df.select(*BRIDGE)


def merge_bridge(target: DataFrame, source: DataFrame) -> DataFrame:
    """New identifiers are added; known ones take last_seen, link_status and patient_key and keep first_seen."""
    return merge_columns(target, source, ["identifier_type", "identifier_value"], ["last_seen", "link_status", "patient_key"])


def bridge_breakdown(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("identifier_type", "link_status").agg(F.count("*").alias("n"))


#: Identifiers that may be broadcast.
SEVERAL_AT_ONCE = 100_000


def pharmacy_links(fills: DataFrame, prescriptions: DataFrame, days: int = 7) -> DataFrame:
    """(pharmacy_patient_id, patient_id), distinct, that share prescriber and drug within the days. Both have prescriber, drug and date.

    A fill meets only the first of a patient's prescriptions within its days, so the links of an identifier with one fill are
    distinct as they are; only those of identifiers with several are made so. Which these are is written to the shared folder
    first: mostly none, and then no fill is shuffled to find out. Prescriptions are copied to two buckets of dates each; the
    optimizer doesn't count copies, so they are never broadcast.
    """
    keys = ["prescriber", "drug"]
    known = lambda df, name: df.select(name, *keys, F.to_date("date").alias("date")).dropna(subset=[*keys, "date"])
    f = known(fills, "pharmacy_patient_id")
    # a copy of a prescription comes after one of the same day, so it is never the first
    p = known(prescriptions, "patient_id").withColumn("before", F.lag("date").over(Window.partitionBy(*keys, "patient_id").orderBy("date"))).hint("merge")
    path = shared_folder(f.sparkSession)
    f.groupBy(F.col("pharmacy_patient_id").alias("_id")).count().filter("count > 1").select("_id").write.parquet(path)
    several = f.sparkSession.read.schema(f.select(F.col("pharmacy_patient_id").alias("_id")).schema).parquet(path)
    many = several.count()
    several = several.hint("merge") if many > SEVERAL_AT_ONCE else several
    of = lambda how: f.join(several, F.col("pharmacy_patient_id").eqNullSafe(F.col("_id")), how)
    first = F.col("before_b").isNull() | (F.datediff("date", "before_b") > days)
    links = lambda df: proximity_join(df, p, keys, "date", days, 2 * days).filter(first).select("pharmacy_patient_id", F.col("patient_id_b").alias("patient_id"))
    return links(of("left_anti")).unionByName(links(of("left_semi")).distinct()) if many else links(f)


def _segment(size: Column, i: Column, parts: Column) -> tuple[Column, Column]:
    """Where the i-th of so many nearly equal parts of a string begins, and its length."""
    start, end = F.floor(i * size / parts).cast("int"), F.floor((i + 1) * size / parts).cast("int")
    return start, end - start


def name_candidates(a: DataFrame, b: DataFrame, block: list[str], least: float = 0.6) -> DataFrame:
    """(block, _x, _y): pairs of names of a block of which at least one part agrees; a and b have the block and a distinct `_name` each.

    Of a pair whose similarity is at least `least`, the longer name of L characters allows t = (1 - least) * L edits. Cut into
    t + 1 parts, the shorter one has a part that no edit touches, so the longer one has it too, at most t places away. Each
    name is listed by its parts for the lengths that its partners can have, and looked up by its substrings: a pair meets
    only on a shared one. Both are bounded by the names' lengths. The optimizer takes them for as small as the names, so the
    joins are told not to broadcast them.
    """
    edits = lambda size: F.floor((1 - least) * size + 1e-9).cast("int")

    def listed(df: DataFrame, name: str, longer: int) -> DataFrame:
        """Names as the shorter side: by their own length, the partner's, and each part."""
        df = df.select(*block, F.col("_name").alias(name), F.length("_name").alias("_l")).withColumn("_L", F.explode(F.sequence(F.col("_l") + longer, F.greatest(F.floor(F.col("_l") / least + 1e-9).cast("int"), F.col("_l") + longer))))
        df = df.filter(F.col("_l") >= least * F.col("_L") - 1e-9).withColumn("_i", F.explode(F.sequence(F.lit(0), edits(F.col("_L")))))
        start, size = _segment(F.col("_l"), F.col("_i"), edits(F.col("_L")) + 1)
        return df.select(*block, name, "_l", "_L", "_i", F.substring(name, start + 1, size).alias("_part"))

    def looked_up(df: DataFrame, name: str) -> DataFrame:
        """Names as the longer side: the substrings that can be a part of a partner of each length."""
        df = df.select(*block, F.col("_name").alias(name), F.length("_name").alias("_L")).withColumn("_l", F.explode(F.sequence(F.ceil(least * F.col("_L") - 1e-9).cast("int"), F.col("_L"))))
        df = df.withColumn("_i", F.explode(F.sequence(F.lit(0), edits(F.col("_L")))))
        start, size = _segment(F.col("_l"), F.col("_i"), edits(F.col("_L")) + 1)
        low, high = F.greatest(F.lit(0), start - edits(F.col("_L"))), F.least(F.col("_L") - size, start + edits(F.col("_L")))
        at = F.when(low <= high, F.sequence(low, high))
        return df.withColumn("_size", size).withColumn("_at", F.explode(at)).select(*block, name, "_l", "_L", "_i", F.substring(name, F.col("_at") + 1, F.col("_size")).alias("_part")).distinct()

    on = [*block, "_l", "_L", "_i", "_part"]
    first = listed(a, "_x", 0).hint("merge").join(looked_up(b, "_y"), on)
    second = listed(b, "_y", 1).hint("merge").join(looked_up(a, "_x"), on)
    return first.select(*block, "_x", "_y").unionByName(second.select(*block, "_x", "_y")).distinct()


def fuzzy_links(a: DataFrame, b: DataFrame, block: list[str], name: str, least: float = 0.6, before: str | None = None) -> DataFrame:
    """Pairs of a block whose names' edit similarity is at least `least`; confidence runs from 0.6 to 0.9 with it.

    Names are compared once however many rows of a block have them, and only with those that `name_candidates` gives. With
    `before`, a column of both sides, a pair of one table comes once, the side with the lesser value first. Rows without a
    name, or with a null in the block, have no links. No side is broadcast: few names make small files of many rows.
    """
    key = lambda c: F.lower(F.trim(c))
    each = lambda df: df.select(*block, key(name).alias("_name")).filter("_name IS NOT NULL").distinct()
    pairs = name_candidates(each(a), each(b), block, least)
    longer = F.greatest(F.length("_x"), F.length("_y"), F.lit(1))
    pairs = pairs.withColumn("similarity", 1 - F.levenshtein("_x", "_y") / longer).filter(F.col("similarity") >= least)
    other = b.withColumn("_y", key(name)).select("_y", *[F.col(c).alias(f"{c}_b") for c in b.columns])
    same = [F.col(f"p.{k}") == F.col(f"{k}_b") for k in block]
    df = a.withColumn("_x", key(name)).hint("merge").join(pairs, [*block, "_x"]).alias("p").join(other.hint("merge"), reduce(Column.__and__, [*same, F.col("p._y") == other["_y"]]))
    if before:
        df = df.filter(F.col(before) < F.col(f"{before}_b"))
    return df.select(*[F.col(f"p.{c}") for c in a.columns], *[f"{c}_b" for c in b.columns], F.col("p.similarity"), (0.6 + 0.3 * (F.col("p.similarity") - least) / (1 - least)).alias("confidence"))


#: Edges of which a task finds the parts at once.
EDGES_AT_ONCE = 1 << 20


def least_of_part(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's part, for edges between nodes 0..n - 1."""
    to = np.arange(n)
    while True:
        before, grand = to.copy(), to[to]
        np.minimum.at(to, before[a], grand[b])
        np.minimum.at(to, before[b], grand[a])
        np.minimum.at(to, a, grand[b])
        np.minimum.at(to, b, grand[a])
        to = np.minimum(to, grand)
        if (to == before).all():
            return to


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) for the nodes a of each so many edges: b is the least node that these edges connect a with."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        codes = pa.chunked_array([*t.column(0).chunks, *t.column(1).chunks]).combine_chunks().dictionary_encode()
        order = pc.sort_indices(codes.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        at = rank[codes.indices.to_numpy()]
        nodes = codes.dictionary.take(order)
        return pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(least_of_part(at[: t.num_rows], at[t.num_rows :], len(nodes))))], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= EDGES_AT_ONCE:
            yield star(held)
            held = []
    if any(x.num_rows for x in held):
        yield star(held)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component): the least node of each component. Nulls link nothing; nodes of any type that can be ordered.

    The graph is contracted in rounds. In each, tasks first replace their edges, a bounded number at a time, by stars with
    the same parts. Then every node joins the first node of its neighbourhood, and the edges between the joined nodes are
    the next round's graph. First is the least node in even rounds and the first by a new hash in odd ones, so that also long
    paths lose a constant share of their nodes. Components that are one node leave the graph, so all rounds together cost
    about as much as the first few. Minima are combined before the shuffle, and the lookup of a hub's edges is a join of many
    rows with one, which adaptive execution splits. Each step is written to the shared folder: a lost executor costs one step.
    """
    spark = edges.sparkSession

    def keep(df: DataFrame) -> DataFrame:
        path = shared_folder(spark)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    e = keep(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not e.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        star = keep(e.mapInArrow(_stars, e.schema))
        rank = lambda c, k=len(rounds): F.struct((F.xxhash64(F.lit(k), c) if k % 2 else F.lit(0).cast("long")).alias("h"), F.col(c).alias("n"))
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = keep(both.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a")))["n"].alias("r")))
        rounds.append(near)
        x, y = near.withColumnRenamed("r", "x"), near.select(F.col("a").alias("b"), F.col("r").alias("y"))
        e = keep(star.join(x, "a").join(y, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not rounds:
        return e.select(F.col("a").alias("node"), F.col("a").alias("component"))
    root = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        root = earlier.join(root.select(F.col("a").alias("r"), F.col("r").alias("s")), "r", "left").select("a", F.coalesce("s", "r").alias("r"))
    root = keep(root)
    return root.join(root.groupBy("r").agg(F.min("a").alias("component")), "r").select(F.col("a").alias("node"), "component")
