from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.operators import checks, identity, scd

V = "k int, h string, effective_start date, effective_end date, is_current boolean"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_scd1_and_insert_only(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(scd.merge_scd1(t, s, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(scd.merge_insert_only(t, s, ["k"])) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(scd.merge_scd1(scd.merge_scd1(t, s, ["k"]), s, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]


def test_scd2_closes_adds_and_is_idempotent(spark):
    t = spark.createDataFrame([(1, "x", date(2024, 1, 1), None, True), (2, "y", date(2024, 1, 1), None, True)], V)
    s = spark.createDataFrame([(1, "z", date(2024, 2, 1), None, True), (2, "y", date(2024, 2, 1), None, True), (3, "w", date(2024, 2, 1), date(2024, 3, 1), False)], V)
    once = scd.merge_scd2(t, s, ["k"], "h")
    want = [(1, "x", date(2024, 1, 1), date(2024, 2, 1), False), (1, "z", date(2024, 2, 1), None, True), (2, "y", date(2024, 1, 1), None, True), (3, "w", date(2024, 2, 1), date(2024, 3, 1), False)]
    assert rows(once) == sorted(want, key=str)
    assert rows(scd.merge_scd2(once, s, ["k"], "h")) == rows(once)
    assert rows(scd.merge_scd2(t.limit(0), s, ["k"], "h")) == rows(s)


@FEW
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 28), st.sampled_from("abc")), min_size=1, max_size=15))
def test_history_passes_the_audit(spark, data):
    df = spark.createDataFrame([(k, date(2024, 1, d), h, i) for i, (k, d, h) in enumerate(data)], "k int, d date, h string, seq int")
    out = scd.history(df, ["k"], "d", "h", ["seq"])
    assert all(r.value == 0 for r in checks.audit_scd2(out, ["k"]).collect())
    assert {r.k for r in out.collect()} == {k for k, _, _ in data}


def test_history_with_stop_and_restart(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1), "on", 0), (1, date(2024, 2, 1), "stopped", 1), (1, date(2024, 3, 1), "on", 2)], "k int, d date, h string, seq int")
    out = scd.history(df, ["k"], "d", "h", ["seq"], live=F.col("h") == "on").select("effective_start", "effective_end", "is_current")
    assert rows(out) == [(date(2024, 1, 1), date(2024, 2, 1), False), (date(2024, 3, 1), None, True)]


def test_audit_finds_defects(spark):
    bad = [(1, "a", date(2024, 1, 1), None, True), (1, "b", date(2024, 2, 1), None, True), (2, "c", date(2024, 1, 5), date(2024, 1, 5), False), (3, "d", date(2024, 1, 1), date(2024, 2, 1), True), (4, "e", date(2024, 1, 1), date(2024, 1, 2), False), (4, "f", date(2024, 1, 9), None, False)]
    got = {r.object: int(r.value) for r in checks.audit_scd2(spark.createDataFrame(bad, V), ["k"]).collect()}
    assert got == {"several_current": 1, "no_current": 2, "current_with_end": 1, "closed_without_end": 1, "overlap": 1, "gap": 1, "empty_version": 1}


def test_cdc(spark):
    t = spark.createDataFrame([("1", "old"), ("2", "old")], "rx string, s string")
    e = spark.createDataFrame([("1", "u", "a", 5, 0), ("1", "u", "b", 5, 1), ("2", "d", None, 6, 2), ("3", "c", "n", 1, 3), ("3", "d", None, 2, 4)], "rx string, op string, s string, ts long, off long")
    assert rows(scd.apply_cdc(t, e, ["rx"], ["ts", "off"])) == [("1", "b"), ("2", "old"), ("3", "n")]
    assert rows(scd.apply_cdc(t, e, ["rx"], ["ts", "off"], apply_deletes=True)) == [("1", "b")]


def test_erasure(spark):
    df = spark.createDataFrame([("p", "name", 1.0), ("q", "other", 2.0)], "id string, name string, v double")
    assert rows(scd.erase(df, spark.createDataFrame([("p",)], "id string"), "id", ["name"])) == [("p", None, 1.0), ("q", "other", 2.0)]


def test_bridge(spark):
    c = spark.createDataFrame([("M1", " A@x.com"), ("M1", "a@x.com"), (None, "z@x.com")], "patient_id string, patient_email string")
    seen, later = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    bridge = identity.bridge_rows(identity.ehr_pairs(c, c), seen)
    assert sorted((r.identifier_type, r.identifier_value) for r in bridge.collect()) == [("email", "a@x.com"), ("hospital_mrn", "M1")]
    r = spark.createDataFrame([("acct",), ("acct",), ("lone",), (None,)], "device_account_id string")
    first = identity.pending_devices(r, seen)
    linked = identity.link_devices(identity.pending_devices(r, later), spark.createDataFrame([("acct", "A@X.com ")], "device_account_id string, email string"))
    out = {x.identifier_value: x for x in identity.merge_bridge(first, linked).collect()}
    assert out["acct"].link_status == "linked" and out["acct"].patient_key is not None and str(out["acct"].first_seen) == "2024-01-01 00:00:00" and str(out["acct"].last_seen) == "2024-02-01 00:00:00"
    assert out["lone"].link_status == "pending_registration" and out["lone"].patient_key is None


@FEW
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=20))
def test_components(spark, edges):
    got = {r.node: r.component for r in identity.connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("least", [0.6, 0.8, 0.5])
def test_fuzzy_links_lose_no_pair(spark, least):
    import random

    r = random.Random(7)
    names = ["", "a", "b", "ab", None] + ["".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(60)]
    names += ["".join(r.choice("abcdefgh") if r.random() < 0.2 else c for c in "some longer name") for _ in range(20)]
    rows = [(k, n, k % 2) for k, n in enumerate(names)]
    df = spark.createDataFrame(rows, "k int, name string, g int")
    same = lambda x, y: 1 - edits(x, y) / max(len(x), len(y), 1) >= least
    want = sorted((i, j) for i, x, g in rows for j, y, h in rows if g == h and i < j and x is not None and y is not None and same(x, y))
    got = identity.fuzzy_links(df, df, ["g"], "name", least, "k")
    assert sorted((x.k, x.k_b) for x in got.collect()) == want and got.columns == ["k", "name", "g", "k_b", "name_b", "g_b", "similarity", "confidence"]


def test_candidates_do_not_grow_with_copies(spark):
    df = spark.createDataFrame([(f"name {k % 30} of {k % 7}", k % 3) for k in range(200)], "_name string, g int")
    n = identity.name_candidates(df.distinct(), df.distinct(), ["g"]).count()
    names = df.distinct().groupBy("g").count().agg({"count": "max"}).first()[0]
    assert n < 3 * names * names
    many = df.unionByName(df).unionByName(df)
    assert identity.name_candidates(many.distinct(), many.distinct(), ["g"]).count() == n


def test_fuzzy_links_broadcast_nothing(spark):
    """The parts of names are hundreds of rows for each name, and the optimizer doesn't know."""
    from pulsegrid.plans.queries import QUERIES

    from .conftest import SF

    df = QUERIES["l7_fuzzy_links"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 4 and "Broadcast" not in plan


def test_fuzzy(spark):
    a = spark.createDataFrame([("Jon Smith", 1980, "1"), ("Ann Lee", 1980, "1")], "name string, y int, zip string")
    b = spark.createDataFrame([("John Smith", 1980, "1"), ("Jon Smith", 1981, "1")], "name string, y int, zip string")
    got = identity.fuzzy_links(a, b, ["y", "zip"], "name").collect()
    assert [(r.name, r.name_b, round(r.similarity, 2)) for r in got] == [("Jon Smith", "John Smith", 0.9)] and 0.6 < got[0].confidence < 0.9


def test_pharmacy_links_take_every_order_as_a_fill(spark):
    from collections import defaultdict

    from pulsegrid.plans.queries import QUERIES

    from .conftest import SF

    orders = [(r.o_orderkey, r.o_custkey, r.o_orderpriority, r.o_orderdate.toordinal()) for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate")).collect()]
    by = defaultdict(list)
    for _, c, p, d in orders:
        by[c % 50, p].append((c, d))
    want = {(f"PH{k}", f"MRN{c}") for k, own, p, at in orders for c, d in by[own % 50, p] if abs(at - d) <= 7}
    got = [tuple(r) for r in QUERIES["l6_pharmacy_links"](spark, SF).collect()]
    assert set(got) == want and len(got) == len(want)
    assert {k for k, _ in got} == {f"PH{r[0]}" for r in orders}


def test_pharmacy_links_of_distant_customers(spark, folder):
    """Customers 7, 57 and 15007 share a prescriber, 7 and 8 do not."""
    import duckdb

    from pulsegrid.plans.queries import ORACLE_SQL, QUERIES

    orders = [(k, c, "1-URGENT", date(2024, 1, d)) for k, c, d in ((1, 7, 1), (2, 57, 8), (3, 15007, 9), (4, 8, 1))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate date").write.parquet(f"{folder}/orders.parquet")
    want = {(1, 7), (1, 57), (2, 7), (2, 57), (2, 15007), (3, 57), (3, 15007), (4, 8)}
    got = [tuple(r) for r in QUERIES["l6_pharmacy_links"](spark, folder).collect()]
    assert sorted(got) == sorted((f"PH{k}", f"MRN{c}") for k, c in want)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder}/orders.parquet/*.parquet'")
    assert sorted(duck.execute(ORACLE_SQL["l6_pharmacy_links"]).fetchall()) == sorted(got)


def test_pharmacy_links_shuffle_each_side_once(spark):
    """Fills once, prescriptions once by patient and once as two copies; the optimizer doesn't count copies, so none is broadcast."""
    from pulsegrid.plans.queries import QUERIES

    from .conftest import SF

    df = QUERIES["l6_pharmacy_links"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Broadcast" not in plan


@pytest.mark.parametrize("at_once", [0, 100])
def test_pharmacy_links_of_identifiers_with_several_fills(spark, monkeypatch, at_once):
    monkeypatch.setattr(identity, "SEVERAL_AT_ONCE", at_once)
    f = spark.createDataFrame([(i, k, "x", date(2024, 1, d)) for i, k, d in (("a", 1, 1), ("a", 2, 9), ("b", 1, 3), (None, 1, 20), (None, 1, 20))], "pharmacy_patient_id string, prescriber int, drug string, date date")
    p = spark.createDataFrame([(i, k, "x", date(2024, 1, d)) for i, k, d in (("m", 1, 1), ("m", 1, 1), ("m", 1, 5), ("m", 2, 16), ("n", 1, 27), ("n", 1, 13), (None, 2, 2))], "patient_id string, prescriber int, drug string, date date")
    assert rows(identity.pharmacy_links(f, p)) == sorted([("a", "m"), ("a", None), ("b", "m"), (None, "n")], key=str)


DAY = st.none() | st.integers(1, 28).map(lambda d: date(2024, 1, d))
SEEN = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, None]), st.sampled_from(["x", "y", None]), DAY)


@FEW
@given(st.lists(SEEN, max_size=25), st.lists(SEEN, max_size=25), st.sampled_from([0, 2, 7]))
def test_pharmacy_links_equal_brute_force(spark, fills, prescriptions, days):
    """Copies, nulls, identifiers with several fills, patients with several prescriptions within the days."""
    fills, prescriptions = fills + fills[:3], prescriptions + prescriptions[:3]
    schema = "{} string, prescriber int, drug string, date date"
    f, p = spark.createDataFrame(fills, schema.format("pharmacy_patient_id")), spark.createDataFrame(prescriptions, schema.format("patient_id"))
    got = rows(identity.pharmacy_links(f, p, days))
    assert got == sorted({(a, b) for a, *x, d in fills for b, *y, e in prescriptions if x == y and None not in (*x, d, e) and abs((d - e).days) <= days}, key=str)
