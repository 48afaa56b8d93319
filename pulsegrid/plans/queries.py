"""A query for each operator of the inventory over the given tables, and DuckDB SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions import keys as K
from pulsegrid.operators import checks, dims, facts, identity, joins, parse, quality, scd, windows
from pulsegrid.sources import adapter as A
from pulsegrid.sources import tables as T
from pulsegrid.streaming import ingest

from .views import view
from .warehouse import Warehouse, run_pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r4(c: Column | str) -> Column:
    """Rounded to 4 places, ties up whatever the last bit."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 4)


def key(expr: str) -> str:
    return f"CAST('0x' || substr(sha256({expr}), 1, 15) AS BIGINT)"


def dkey(expr: str) -> str:
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) AS INTEGER)"


def case(expr: str, table: dict[str, str], default: str) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE '{default}' END"


DEVICE = case("event_type", A.DEVICE_OF, "smartwatch")
#: Silver readings, and the bridge's device accounts, straight from events.
READINGS = f"""
ev AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, {DEVICE} AS device_type FROM events),
s AS (SELECT event_id, user_id, CAST(event_id AS VARCHAR) AS reading_id, {case('device_type', A.PREFIX_OF, 'XX')} || '-' || user_id AS device_id, device_type, 'acct_' || user_id AS device_account_id,
        'v' || (k % 4) AS firmware_version, CAST(event_id % 101 AS INTEGER) AS battery_pct, ts AS event_timestamp, CAST(floor(epoch(ts)) AS BIGINT) AS event_s,
        CASE WHEN event_id % 211 = 0 THEN 200000 WHEN event_id % 10 < 3 THEN (event_id * 37) % 28800 ELSE 0 END AS lag_s, event_type AS metric_name,
        CASE WHEN event_id % 100 = 0 OR event_id % 97 = 0 THEN NULL ELSE value END AS metric_value FROM ev),
r AS (SELECT *, coalesce(metric_value BETWEEN 0 AND 150, FALSE) AS is_valid, lag_s > 7200 AS is_late_arriving,
        {key("CASE WHEN user_id % 5 <> 0 THEN sha256('u' || user_id || '@example.com') ELSE device_account_id END")} AS patient_key,
        {key("metric_name || '|' || device_type")} AS metric_key, {key("device_id || '|' || firmware_version")} AS device_key,
        {key("reading_id || '|' || metric_name")} AS reading_key, {dkey("event_timestamp")} AS date_key,
        CAST(hour(event_timestamp) * 100 + minute(event_timestamp) AS INTEGER) AS time_key FROM s)"""
DAILY = """
d AS (SELECT patient_key, metric_key, metric_name, date_key, avg(metric_value) FILTER (is_valid) AS avg_value, min(metric_value) FILTER (is_valid) AS min_value, max(metric_value) FILTER (is_valid) AS max_value,
        count(*) AS reading_count, sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS anomaly_count, 100 * avg(CASE WHEN is_valid AND metric_value BETWEEN 5 AND 100 THEN 1 ELSE 0 END) AS pct,
        quantile_cont(metric_value, 0.25) FILTER (is_valid) AS p25, quantile_cont(metric_value, 0.75) FILTER (is_valid) AS p75 FROM r GROUP BY ALL)"""
STATS = """
st AS (SELECT *, avg(metric_value) OVER w AS m, stddev_samp(metric_value) OVER w AS sd FROM r WHERE is_valid
       WINDOW w AS (PARTITION BY patient_key, metric_name ORDER BY event_s RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)),
al AS (SELECT *, (metric_value - m) / sd AS z FROM st WHERE sd > 0 AND abs((metric_value - m) / sd) > 2)"""
#: Days of a patient's metric whose seven-day slope is beyond its own past ones, and all alerts.
TRENDS = f"""
td AS (SELECT patient_key, metric_key, metric_name, CAST(event_timestamp AS DATE) AS day, date_key, date_diff('day', DATE '1970-01-01', CAST(event_timestamp AS DATE)) AS x, avg(metric_value) AS v, max(time_key) AS time_key FROM r WHERE is_valid GROUP BY ALL),
tl AS (SELECT *, CASE WHEN count(v) OVER w >= 3 THEN regr_slope(v, x) OVER w END AS slope FROM td WINDOW w AS (PARTITION BY patient_key, metric_key ORDER BY x RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)),
tp AS (SELECT *, count(slope) OVER w AS n, avg(slope) OVER w AS m, stddev_samp(slope) OVER w AS sd FROM tl WINDOW w AS (PARTITION BY patient_key, metric_key ORDER BY x RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)),
tr AS (SELECT *, {key("patient_key || '|' || metric_key || '|' || date_key || '|trend_deviation'")} AS alert_key, (slope - m) / sd AS z FROM tp WHERE n >= 5 AND sd > 0 AND abs((slope - m) / sd) > 2)"""
ALERT_TYPE = "CASE WHEN abs(z) > 3 THEN 'sudden_spike' WHEN z > 2 THEN 'sustained_high' ELSE 'sustained_low' END"
SEVERITY = "CASE WHEN abs(z) > 4 THEN 'critical' WHEN abs(z) > 3 THEN 'high' ELSE 'medium' END"
#: The people: customers with orders, linked by e-mail to registered accounts.
PEOPLE = f"""
cu AS (SELECT DISTINCT o_custkey AS c FROM orders),
ac AS (SELECT DISTINCT user_id AS u FROM events)"""
CODE = "['" + "', '".join(A.CODES) + "'][(o_custkey * 3 + o_orderkey) % 7 + 1]"
AGE = "CASE WHEN c_custkey IS NULL THEN 'Unknown' WHEN 2024 - (1935 + c_custkey % 85) < 18 THEN '0-17' WHEN 2024 - (1935 + c_custkey % 85) < 35 THEN '18-34' WHEN 2024 - (1935 + c_custkey % 85) < 50 THEN '35-49' WHEN 2024 - (1935 + c_custkey % 85) < 65 THEN '50-64' ELSE '65+' END"
PATIENT = f"""
po AS (SELECT c, {key("sha256('u' || c || '@example.com')")} AS patient_key, sha256('mrn' || c) AS patient_id_masked, {AGE} AS age_group
       FROM cu LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0) ON c = c_custkey)"""
HALF = "DATE '1998-06-01'"
VERSIONS = """
vb AS (SELECT o_custkey AS patient, CAST(o_orderdate AS DATE) AS batch_date, o_orderstatus AS status, o_orderpriority AS dosage, o_orderkey AS seq, sha256(o_orderstatus || '||' || o_orderpriority) AS row_hash FROM orders)"""
HISTORY = """
{n}1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient, batch_date ORDER BY seq DESC) AS rn FROM vb WHERE {where}) WHERE rn = 1),
{n}2 AS (SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY patient ORDER BY batch_date) AS b FROM {n}1) WHERE b IS DISTINCT FROM row_hash),
{n} AS (SELECT patient, status, dosage, row_hash, batch_date AS effective_start, lead(batch_date) OVER (PARTITION BY patient ORDER BY batch_date) AS effective_end FROM {n}2)"""
LABS = """
lb AS (SELECT 'MRN' || l_suppkey AS patient_id, CASE l_returnflag WHEN 'A' THEN 'HbA1c' WHEN 'N' THEN 'LDL' ELSE 'TSH' END AS test_code, l_quantity AS value, CAST(l_shipdate AS DATE) AS test_date FROM lineitem)"""
DRUG = "['" + "', '".join(d.lower() for d in A.DRUGS) + "'][l_partkey % 7 + 1]"
FILLS = f"""
fl AS (SELECT l_orderkey || '-' || l_linenumber AS rx_id, 'PH' || l_suppkey AS pharmacy_patient_id, CASE WHEN l_partkey % 7 < 6 THEN {DRUG} WHEN l_partkey % 2 = 0 THEN 'omeprazole' END AS drug,
        {dkey("l_shipdate")} AS date_key, CAST(l_shipdate AS DATE) AS fill_date, CAST(l_linenumber - 1 AS INTEGER) AS refill_number, CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'complete' END AS status FROM lineitem),
ff AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rx_id ORDER BY date_key, refill_number, status, {key("drug")}, {key("pharmacy_patient_id")}) AS rn FROM fl) WHERE rn = 1)"""
CHANGES = """
ch AS (SELECT CAST(o_orderkey AS VARCHAR) AS rx_id, 'c' AS op, o_orderstatus AS status, o_custkey AS patient, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS ts_ms, o_orderkey * 3 AS off FROM orders
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'u', 'X', o_custkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000 + 86400000, o_orderkey * 3 + 1 FROM orders WHERE o_orderkey % 2 = 0
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'd', o_orderstatus, o_custkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000 + 86400000, o_orderkey * 3 + 2 FROM orders WHERE o_orderkey % 10 = 0)"""


# sources, parsing, flags


@query(f"WITH {READINGS} SELECT kafka_partition, count(*) AS n, CAST(sum(b) AS BIGINT) AS sum_offset FROM (SELECT CAST(user_id % 6 AS INTEGER) AS kafka_partition, event_id * 2 + x AS b FROM r, (SELECT unnest([0, 1]) AS x) WHERE x = 0 OR event_id % 50 = 0) GROUP BY 1")
def a1_bronze_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return A.bronze(A.load(spark, sf, "events")).groupBy("kafka_partition").agg(F.count("*").alias("n"), F.sum("kafka_offset").alias("sum_offset"))


@query(f"WITH {READINGS} SELECT reading_id, device_id, device_type, device_account_id, firmware_version, battery_pct, event_s, event_s + lag_s + x AS sync_s FROM r, (SELECT unnest([0, 3600]) AS x) WHERE x = 0 OR event_id % 50 = 0")
def b1_parse_readings(spark: SparkSession, sf: str) -> DataFrame:
    df = parse.parse_readings(A.bronze(A.load(spark, sf, "events")))
    return df.select("reading_id", "device_id", "device_type", "device_account_id", "firmware_version", "battery_pct", F.unix_timestamp("event_timestamp").alias("event_s"), F.unix_timestamp("sync_timestamp").alias("sync_s"))


@query(f"WITH {READINGS} SELECT metric_name, count(*) AS n, count(metric_value) AS n_values, count(*) FILTER (event_id % 97 = 0 AND event_id % 100 <> 0) AS n_text, round(sum(metric_value) + 1e-9, 4) AS total FROM r, (SELECT unnest([0, 1]) AS x) WHERE x = 0 OR event_id % 50 = 0 GROUP BY 1")
def b3_explode_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = parse.explode_metrics(parse.parse_readings(A.bronze(A.load(spark, sf, "events"))))
    return df.groupBy("metric_name").agg(F.count("*").alias("n"), F.count("metric_value").alias("n_values"), F.count(F.when(F.col("metric_text").isNotNull() & F.col("metric_value").isNull(), 1)).alias("n_text"), r4(F.sum("metric_value")).alias("total"))


@query(f"WITH {READINGS} SELECT reading_id, metric_value, is_valid, is_late_arriving, lag_s > 172800 AS is_very_late FROM r")
def b7_quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.flag_late(A.readings(spark, sf), seconds=quality.VERY_LATE_SECONDS, name="is_very_late")
    return df.select("reading_id", "metric_value", "is_valid", "is_late_arriving", "is_very_late")


@query(f"WITH {READINGS} SELECT reading_id, coalesce(metric_value BETWEEN 5 AND 100, FALSE) AS in_normal_range, date_key, time_key, reading_key, metric_key FROM r")
def b10_normal_range_and_keys(spark: SparkSession, sf: str) -> DataFrame:
    df = facts.with_metric(A.readings(spark, sf), dims.dim_metric(spark, A.METRICS))
    return quality.flag_normal(df, "metric_value", "normal_low", "normal_high").select("reading_id", "in_normal_range", K.date_key("event_timestamp").alias("date_key"), K.time_key("event_timestamp").alias("time_key"), K.surrogate_key("reading_id", "metric_name").alias("reading_key"), "metric_key")


@query("SELECT c_custkey, sha256('u' || c_custkey || '@example.com') AS person, CASE WHEN a < 18 THEN '0-17' WHEN a < 35 THEN '18-34' WHEN a < 50 THEN '35-49' WHEN a < 65 THEN '50-64' ELSE '65+' END AS age_group, sha256(c_name || '||' || coalesce(c_mktsegment, '')) AS row_hash FROM (SELECT *, 2024 - (1935 + c_custkey % 85) AS a FROM customer)")
def b15_mask_and_age(spark: SparkSession, sf: str) -> DataFrame:
    c = A.load(spark, sf, "customer")
    return c.select("c_custkey", K.person_key(F.concat(F.lit(" U"), F.col("c_custkey"), F.lit("@Example.com "))).alias("person"), K.age_group((F.lit(1935) + F.col("c_custkey") % 85).cast("int"), 2024).alias("age_group"), K.row_hash("c_name", "c_mktsegment").alias("row_hash"))


@query(f"WITH {READINGS} SELECT device_id, {case('substr(device_id, 1, 2)', K.MODELS, 'Unknown')} AS model, {case('device_type', K.ZONES, 'unknown')} AS body_zone, count(*) AS n FROM r GROUP BY 1, 2, 3")
def b21_device_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return A.readings(spark, sf).groupBy("device_id", K.device_model("device_id").alias("model"), K.body_zone("device_type").alias("body_zone")).agg(F.count("*").alias("n"))


@query(f"WITH {READINGS}, q AS (SELECT *, event_id % 50 = 0 AS dup FROM r, (SELECT unnest([0, 3600]) AS x) WHERE x = 0 OR event_id % 50 = 0) SELECT reading_id, dup AS is_duplicate, CAST(CASE WHEN NOT is_valid THEN 0.0 ELSE 1.0 - CASE WHEN lag_s + x > 7200 THEN 0.25 ELSE 0 END - CASE WHEN dup THEN 0.25 ELSE 0 END END AS DOUBLE) AS quality_score FROM q")
def b23_quality_score(spark: SparkSession, sf: str) -> DataFrame:
    df = A.to_silver(A.bronze(A.load(spark, sf, "events")), dedup=False)
    return quality.quality_score(quality.flag_duplicates(df, ["reading_id", "metric_name"])).select("reading_id", "is_duplicate", "quality_score")


@query("SELECT l_partkey, CASE WHEN l_partkey % 2 = 0 THEN 'omeprazole' END AS drug, count(*) AS n FROM lineitem GROUP BY 1, 2")
def b24_ndc_mapping(spark: SparkSession, sf: str) -> DataFrame:
    li = A.load(spark, sf, "lineitem").withColumn("ndc", F.when(F.col("l_partkey") % 2 == 0, "68180-0512").otherwise("99999-1"))
    return li.groupBy("l_partkey", K.drug_of_ndc("ndc").alias("drug")).agg(F.count("*").alias("n"))


# windows


@query(f"WITH {READINGS} SELECT reading_id, metric_name, event_s + lag_s AS sync_s FROM r")
def e1_first_arrival(spark: SparkSession, sf: str) -> DataFrame:
    return A.readings(spark, sf).select("reading_id", "metric_name", F.unix_timestamp("sync_timestamp").alias("sync_s"))


@query(f"WITH {CHANGES} SELECT rx_id, op, status FROM (SELECT *, row_number() OVER (PARTITION BY rx_id ORDER BY ts_ms DESC, off DESC) AS rn FROM ch) WHERE rn = 1")
def e2_latest_change(spark: SparkSession, sf: str) -> DataFrame:
    return windows.keep_latest(A.changes(spark, sf), ["rx_id"], "ts_ms", "offset").select("rx_id", "op", "status")


@query(f"WITH {READINGS}, {STATS} SELECT reading_id, round(m + 1e-9, 4) AS rolling_mean, round(sd + 1e-9, 4) AS rolling_std FROM st")
def e3_rolling_stats(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    df = windows.rolling_stats(facts.with_patient(w.readings.filter("is_valid"), w.bridge), ["patient_key", "metric_name"])
    return df.select("reading_id", r4("rolling_mean").alias("rolling_mean"), r4("rolling_std").alias("rolling_std"))


ALERTS = f"""
aa AS (SELECT reading_key AS alert_key, patient_key, metric_key, metric_name, CAST(event_timestamp AS DATE) AS day, date_key, time_key, {ALERT_TYPE} AS alert_type, {SEVERITY} AS severity, metric_value, m, sd, z FROM al
       UNION ALL SELECT alert_key, patient_key, metric_key, metric_name, day, date_key, time_key, 'trend_deviation', {SEVERITY}, slope, m, sd, z FROM tr)"""


@query(f"WITH {READINGS}, {STATS}, {TRENDS}, {ALERTS} SELECT alert_key, patient_key, metric_key, date_key, time_key, alert_type, severity, round(metric_value + 1e-9, 4) AS metric_value, round(m + sign(z) * 2 * sd + 1e-9, 4) AS threshold_value, round(m + 1e-9, 4) AS patient_baseline FROM aa")
def n5_anomaly_alerts(spark: SparkSession, sf: str) -> DataFrame:
    df = Warehouse(spark, sf, stored=True).fact_anomaly_alert
    return df.select("alert_key", "patient_key", "metric_key", "date_key", "time_key", "alert_type", "severity", r4("metric_value").alias("metric_value"), r4("threshold_value").alias("threshold_value"), r4("patient_baseline").alias("patient_baseline"))


@query("WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1, 2), m AS (SELECT *, avg(v) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS a FROM d) SELECT event_type, CAST(day AS VARCHAR) AS day, round(a + 1e-9, 4) AS moving_avg, round(100 * (v - a) / a + 1e-9, 4) AS pct_change, CASE WHEN a IS NULL THEN NULL WHEN 100 * (v - a) / a > 2 THEN 'up' WHEN 100 * (v - a) / a < -2 THEN 'down' ELSE 'stable' END AS direction FROM m")
def e6_trend(spark: SparkSession, sf: str) -> DataFrame:
    d = A.load(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    return windows.trend(d, ["event_type"], "day", "v", flat=2.0).select("event_type", F.col("day").cast("string").alias("day"), r4("moving_avg").alias("moving_avg"), r4("pct_change").alias("pct_change"), "direction")


@query("WITH i AS (SELECT *, event_id - row_number() OVER (PARTITION BY event_type, f ORDER BY event_id) AS x FROM (SELECT event_id, event_type, value > 20 AS f, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS o FROM events)), j AS (SELECT *, o - row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS y FROM i WHERE f) SELECT event_type, min(event_id) AS run_start, max(event_id) AS run_end, count(*) AS run_length FROM j GROUP BY event_type, y HAVING count(*) >= 5")
def e7_sustained_runs(spark: SparkSession, sf: str) -> DataFrame:
    return windows.runs_in_parts(A.load(spark, sf, "events"), ["event_type"], ["event_id"], F.col("value") > 20, F.floor(F.col("event_id") / 65536), 5)


@query(f"WITH {FILLS}, g AS (SELECT pharmacy_patient_id, drug, fill_date, refill_number, rx_id, lag(fill_date + 30) OVER (PARTITION BY pharmacy_patient_id, drug ORDER BY fill_date, rx_id) AS e FROM ff WHERE drug IS NOT NULL) SELECT rx_id, CAST(fill_date - e AS INTEGER) AS gap_days, coalesce(fill_date > e, FALSE) AS is_gap FROM g")
def e8_refill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    df = A.fills(spark, sf).withColumn("drug", F.coalesce(F.when(K.first_word("drug_name") != "ibuprofen", K.first_word("drug_name")), K.drug_of_ndc("ndc_code"))).withColumn("day", F.to_date("fill_date"))
    df = df.withColumn("drug_key", K.surrogate_key("drug")).withColumn("patient_key", K.surrogate_key("pharmacy_patient_id"))
    df = windows.keep_first(df, ["rx_id"], "day", "refill_number", "status", "drug_key", "patient_key").filter("drug IS NOT NULL")
    return windows.refill_gaps(df, ["pharmacy_patient_id", "drug"], "day", "days_supply", "rx_id").select("rx_id", "gap_days", "is_gap")


@query("SELECT event_type, event_id, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 3")
def f3_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return windows.top_k(A.load(spark, sf, "events"), ["event_type"], 3, F.desc("value"), F.col("event_id")).select("event_type", "event_id", "value", F.col("rank").cast("long").alias("rank"))


@query("WITH g AS (SELECT *, CASE WHEN s - lag(s) OVER w <= 3600 THEN 0 ELSE 1 END AS n FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s)), h AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s RANGE UNBOUNDED PRECEDING) AS no FROM g) SELECT user_id, min(s) AS start_s, max(s) AS end_s, count(*) AS n FROM h GROUP BY user_id, no")
def i8_activity_sessions(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.sessions(A.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), ["user_id"], "ts", 3600)
    return df.select("user_id", F.unix_timestamp("session_start").alias("start_s"), F.unix_timestamp("session_end").alias("end_s"), "n")


# joins


@query(f"WITH {READINGS} SELECT reading_id, patient_key, metric_key, 'units' AS unit FROM r")
def c1_lookups(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return facts.with_metric(facts.with_patient(w.readings, w.bridge), w.dim_metric).select("reading_id", "patient_key", "metric_key", "unit")


@query("SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def c5_parent_dimension(spark: SparkSession, sf: str) -> DataFrame:
    n, r = A.load(spark, sf, "nation"), A.load(spark, sf, "region")
    return joins.left_lookup(n, r.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"], ["r_name"]).select("n_name", "r_name")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)")
def c11_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return joins.orphans(A.load(spark, sf, "orders"), "o_custkey", A.load(spark, sf, "customer").filter("c_custkey % 7 <> 0"), "c_custkey").select("o_orderkey")


@query("SELECT n_name, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def c12_star_join(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = A.load(spark, sf, "orders"), A.load(spark, sf, "customer"), A.load(spark, sf, "nation")
    df = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return df.groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(f"WITH {VERSIONS}, {HISTORY.format(n='h', where='TRUE')} SELECT o.o_orderkey, h.status, h.dosage FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 10 AS at FROM orders) o LEFT JOIN h ON o.o_custkey = h.patient AND h.effective_start <= o.at AND (h.effective_end IS NULL OR o.at < h.effective_end)")
def c15_point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    v = A.versions(spark, sf)
    dim = scd.history(v, ["patient"], "batch_date", "row_hash", ["seq"]).select("patient", "status", "dosage", "effective_start", "effective_end")
    fact = A.load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("patient"), F.date_add(F.to_date("o_orderdate"), 10).alias("at"))
    return joins.asof_scd2(fact, dim, ["patient"], "at").select("o_orderkey", "status", "dosage")


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    e = A.load(spark, sf, "events")
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return e.select(F.col("event_id").alias("session_id"), F.col("user_id").alias("patient"), s.alias("start"), (s + 600 + F.col("event_id") % 1800).alias("end"), (F.col("event_id") % 3).alias("source_rank"))


SESSIONS = "w AS (SELECT event_id AS session_id, user_id AS patient, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + 600 + event_id % 1800 AS e, event_id % 3 AS q FROM events)"


@query(f"WITH {SESSIONS} SELECT session_id FROM w a WHERE NOT EXISTS (SELECT 1 FROM w b WHERE a.patient = b.patient AND a.s < b.e AND b.s < a.e AND (b.q < a.q OR (b.q = a.q AND b.session_id < a.session_id)))")
def n7_activity_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_activity_session(_sessions(spark, sf), ["patient"], "source_rank").select("session_id")


@query(f"WITH {SESSIONS} SELECT a.session_id, b.session_id AS session_id_b FROM w a JOIN w b ON a.patient = b.patient AND a.s < b.e AND b.s < a.e AND a.session_id < b.session_id")
def c16_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    s = _sessions(spark, sf)
    return joins.overlap_join(s, s, ["patient"]).filter("session_id < session_id_b").select("session_id", "session_id_b")


@query("SELECT a.o_orderkey, b.o_orderkey AS o_orderkey_b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))) <= 7 AND a.o_orderkey < b.o_orderkey")
def c17_proximity(spark: SparkSession, sf: str) -> DataFrame:
    o = A.load(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return joins.proximity_join(o, o, ["o_custkey"], "day", 7).filter("o_orderkey < o_orderkey_b").select("o_orderkey", "o_orderkey_b")


# aggregates


@query(f"WITH {READINGS}, {DAILY} SELECT patient_key, metric_key, date_key, round(avg_value + 1e-9, 4) AS avg_value, min_value, max_value, reading_count, CAST(anomaly_count AS BIGINT) AS anomaly_count, round(pct + 1e-9, 4) AS pct_in_normal_range, round(p25 + 1e-9, 4) AS p25_value, round(p75 + 1e-9, 4) AS p75_value FROM d")
def d1_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = Warehouse(spark, sf).fact_vital_daily_summary
    return df.select("patient_key", "metric_key", "date_key", r4("avg_value").alias("avg_value"), "min_value", "max_value", "reading_count", "anomaly_count", r4("pct_in_normal_range").alias("pct_in_normal_range"), r4("p25_value").alias("p25_value"), r4("p75_value").alias("p75_value"))


@query(f"WITH {READINGS} SELECT device_account_id, count(DISTINCT device_id) AS devices, CAST(min(CAST(event_timestamp AS DATE)) AS VARCHAR) AS first_day FROM r GROUP BY 1")
def d3_distinct_devices(spark: SparkSession, sf: str) -> DataFrame:
    return A.readings(spark, sf).groupBy("device_account_id").agg(F.countDistinct("device_id").alias("devices"), F.min(F.to_date("event_timestamp")).cast("string").alias("first_day"))


@query(f"WITH c AS (SELECT 'MRN' || o_custkey AS patient_id, {CODE} AS code, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'F') SELECT patient_id, {key('code')} AS primary_condition_key FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY d, code) AS rn FROM c) WHERE rn = 1")
def d4_primary_condition(spark: SparkSession, sf: str) -> DataFrame:
    return dims.primary_conditions(A.conditions(spark, sf), dims.dim_condition(spark))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")
def d7_having(spark: SparkSession, sf: str) -> DataFrame:
    return A.load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 10")


# upserts and history

COND = f"""
cb AS (SELECT 'MRN' || o_custkey AS patient_id, {CODE} AS code, CASE o_orderstatus WHEN 'F' THEN 'resolved' ELSE 'active' END AS status, CAST(o_orderdate AS DATE) AS d, o_orderkey AS seq FROM orders),
ct AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, code ORDER BY d DESC, seq DESC) AS rn FROM cb WHERE d < {HALF}) WHERE rn = 1),
cs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, code ORDER BY d DESC, seq DESC) AS rn FROM cb WHERE d >= {HALF}) WHERE rn = 1)"""


def _condition_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = A.conditions(spark, sf).drop("patient_email")
    k = ["patient_id", "icd10_code"]
    return tuple(windows.keep_latest(c.filter(p), k, "onset_date", "seq") for p in ("onset_date < '1998-06-01'", "onset_date >= '1998-06-01'"))


@query(f"WITH {COND} SELECT patient_id, code AS icd10_code, status, seq FROM cs UNION ALL SELECT patient_id, code, status, seq FROM ct WHERE (patient_id, code) NOT IN (SELECT patient_id, code FROM cs)")
def k1_scd1_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _condition_halves(spark, sf)
    return scd.merge_scd1(target, source, ["patient_id", "icd10_code"]).select("patient_id", "icd10_code", "status", "seq")


@query(f"WITH {COND} SELECT patient_id, code AS icd10_code, seq FROM ct UNION ALL SELECT patient_id, code, seq FROM cs WHERE (patient_id, code) NOT IN (SELECT patient_id, code FROM ct)")
def k2_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _condition_halves(spark, sf)
    return scd.merge_insert_only(target, source, ["patient_id", "icd10_code"]).select("patient_id", "icd10_code", "seq")


K3 = f"""WITH {VERSIONS}, {HISTORY.format(n='h', where=f'batch_date < {HALF}')},
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY batch_date DESC, seq DESC) AS rn FROM vb WHERE batch_date >= {HALF}) WHERE rn = 1),
f AS (SELECT n.* FROM n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.patient = n.patient AND h.effective_end IS NULL AND h.row_hash = n.row_hash)),
m AS (SELECT h.patient, h.status, h.dosage, h.effective_start, coalesce(h.effective_end, f.batch_date) AS effective_end FROM h LEFT JOIN f ON h.patient = f.patient
      UNION ALL SELECT patient, status, dosage, batch_date, NULL FROM f)
SELECT patient, status, dosage, CAST(effective_start AS VARCHAR) AS effective_start, CAST(effective_end AS VARCHAR) AS effective_end, effective_end IS NULL AS is_current FROM m"""


def _scd2(spark: SparkSession, sf: str) -> DataFrame:
    v = A.versions(spark, sf)
    target = scd.history(v.filter("batch_date < '1998-06-01'"), ["patient"], "batch_date", "row_hash", ["seq"])
    last = windows.keep_latest(v.filter("batch_date >= '1998-06-01'"), ["patient"], "batch_date", "seq")
    source = last.withColumn("effective_start", F.col("batch_date")).withColumn("effective_end", F.lit(None).cast("date")).withColumn("is_current", F.lit(True))
    return scd.merge_scd2(target, source, ["patient"])


def _versions_out(df: DataFrame) -> DataFrame:
    return df.select("patient", "status", "dosage", F.col("effective_start").cast("string").alias("effective_start"), F.col("effective_end").cast("string").alias("effective_end"), "is_current")


@query(K3)
def k3_scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _versions_out(_scd2(spark, sf))


@query(f"WITH {VERSIONS}, {HISTORY.format(n='h', where='TRUE')} SELECT patient, status, dosage, CAST(effective_start AS VARCHAR) AS effective_start, CAST(effective_end AS VARCHAR) AS effective_end, effective_end IS NULL AS is_current FROM h")
def k6_scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return _versions_out(scd.history(A.versions(spark, sf), ["patient"], "batch_date", "row_hash", ["seq"]))


@query(f"""WITH {READINGS}, q AS (SELECT * FROM (SELECT device_id, event_s, firmware_version, lag(firmware_version) OVER (PARTITION BY device_id ORDER BY event_s) AS b FROM (SELECT device_id, event_s, max_by(firmware_version, event_id) AS firmware_version FROM r GROUP BY ALL)) WHERE b IS DISTINCT FROM firmware_version)
SELECT device_id, firmware_version, event_s AS from_s, lead(event_s) OVER (PARTITION BY device_id ORDER BY event_s) AS to_s FROM q""")
def k7_device_history(spark: SparkSession, sf: str) -> DataFrame:
    r = A.readings(spark, sf).select("device_id", "firmware_version", F.unix_timestamp("event_timestamp").alias("s"), F.col("reading_id").cast("long").alias("seq"))
    return scd.history(r, ["device_id"], "s", "firmware_version", ["seq"]).select("device_id", "firmware_version", F.col("effective_start").alias("from_s"), F.col("effective_end").alias("to_s"))


@query(f"WITH {CHANGES}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rx_id ORDER BY ts_ms DESC, off DESC) AS rn FROM ch) WHERE rn = 1) SELECT rx_id, status, patient FROM l WHERE op <> 'd'")
def k5_apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    events = A.changes(spark, sf)
    target = events.filter("op = 'c' AND ts_ms < 900000000000").select("rx_id", "status", "patient")
    return scd.apply_cdc(target, events, ["rx_id"], ["ts_ms", "offset"], apply_deletes=True).select("rx_id", "status", "patient")


@query("SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS c_name, c_acctbal FROM customer")
def k9_erasure(spark: SparkSession, sf: str) -> DataFrame:
    c = A.load(spark, sf, "customer")
    return scd.erase(c, c.filter("c_custkey % 13 = 0"), "c_custkey", ["c_name"]).select("c_custkey", "c_name", "c_acctbal")


# identity


@query(f"WITH {PEOPLE} SELECT sha256('u' || c || '@example.com') AS patient_key, 'hospital_mrn' AS identifier_type, 'MRN' || c AS identifier_value, 'linked' AS link_status FROM cu UNION ALL SELECT sha256('u' || c || '@example.com'), 'email', 'u' || c || '@example.com', 'linked' FROM cu UNION ALL SELECT CASE WHEN u % 5 <> 0 THEN sha256('u' || u || '@example.com') END, 'device_account_id', 'acct_' || u, CASE WHEN u % 5 <> 0 THEN 'linked' ELSE 'pending_registration' END FROM ac")
def l1_identity_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return A.bridge(spark, sf).select("patient_key", "identifier_type", "identifier_value", "link_status")


@query(f"WITH {PEOPLE} SELECT identifier_type, link_status, count(*) AS n FROM (SELECT 'hospital_mrn' AS identifier_type, 'linked' AS link_status FROM cu UNION ALL SELECT 'email', 'linked' FROM cu UNION ALL SELECT 'device_account_id', CASE WHEN u % 5 <> 0 THEN 'linked' ELSE 'pending_registration' END FROM ac) GROUP BY 1, 2")
def l4_bridge_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return identity.bridge_breakdown(A.bridge(spark, sf))


@query(f"WITH {PEOPLE} SELECT 'acct_' || u AS identifier_value, CASE WHEN u % 5 <> 0 THEN 'linked' ELSE 'pending_registration' END AS link_status, CASE WHEN u % 2 = 0 THEN '2024-01-01' ELSE '2024-02-01' END AS first_seen, '2024-02-01' AS last_seen FROM ac")
def k4_bridge_merge(spark: SparkSession, sf: str) -> DataFrame:
    new = A.bridge(spark, sf).filter("identifier_type = 'device_account_id'")
    old = new.filter(F.substring_index("identifier_value", "_", -1).cast("long") % 2 == 0).withColumn("link_status", F.lit("pending_registration")).withColumn("patient_key", F.lit(None).cast("string"))
    for c in ("first_seen", "last_seen"):
        old = old.withColumn(c, F.lit("2024-01-01").cast("timestamp"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return identity.merge_bridge(old, new).select("identifier_value", "link_status", day("first_seen"), day("last_seen"))


@query("SELECT DISTINCT 'PH' || a.o_orderkey AS pharmacy_patient_id, 'MRN' || b.o_custkey AS patient_id FROM orders a JOIN orders b ON a.o_custkey % 50 = b.o_custkey % 50 AND a.o_orderpriority = b.o_orderpriority AND abs(date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))) <= 7")
def l6_pharmacy_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is a fill."""
    o = A.load(spark, sf, "orders").select(F.concat(F.lit("PH"), F.col("o_orderkey")).alias("pharmacy_patient_id"), F.concat(F.lit("MRN"), F.col("o_custkey")).alias("patient_id"), (F.col("o_custkey") % 50).alias("prescriber"), F.col("o_orderpriority").alias("drug"), F.to_date("o_orderdate").alias("date"))
    return identity.pharmacy_links(o.drop("patient_id"), o.drop("pharmacy_patient_id"))


@query("SELECT a.p_partkey, b.p_partkey AS p_partkey_b, round(1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1) + 1e-9, 4) AS similarity FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1) >= 0.6")
def l7_fuzzy_links(spark: SparkSession, sf: str) -> DataFrame:
    p = A.load(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return identity.fuzzy_links(p, p, ["p_brand", "p_size"], "p_name", before="p_partkey").select("p_partkey", "p_partkey_b", r4("similarity").alias("similarity"))


@query("""WITH RECURSIVE ed AS (SELECT DISTINCT 'o' || l_orderkey AS x, 's' || l_suppkey || '-' || (l_partkey % 400) AS y FROM lineitem), e AS (SELECT x AS a, y AS b FROM ed UNION ALL SELECT y, x FROM ed),
cc(node, component) USING KEY (node) AS (SELECT a, least(a, min(b)) FROM e GROUP BY a
UNION SELECT e.b, min(cc.component) FROM cc JOIN e ON cc.node = e.a JOIN recurring.cc AS old ON old.node = e.b WHERE cc.component < old.component GROUP BY e.b)
SELECT node, component FROM cc""")
def l8_components(spark: SparkSession, sf: str) -> DataFrame:
    li = A.load(spark, sf, "lineitem")
    e = li.select(F.concat(F.lit("o"), F.col("l_orderkey")).alias("src"), F.concat(F.lit("s"), F.col("l_suppkey"), F.lit("-"), F.col("l_partkey") % 400).alias("dst"))
    return identity.connected_components(e)


# dimensions


@query("""SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
dayofweek(d) IN (0, 6) AS is_weekend, month(d) IN (10, 11, 12, 1, 2, 3) AS is_flu_season,
(month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25) OR (month(d) = 5 AND dayofweek(d) = 1 AND day(d) >= 25) OR (month(d) = 9 AND dayofweek(d) = 1 AND day(d) <= 7) OR (month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28) AS is_holiday,
CAST(CASE WHEN month(d) >= 10 THEN 1 WHEN month(d) <= 3 THEN 2 WHEN month(d) <= 6 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter_medical, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d - 2000) AS n_orders
FROM (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS d FROM range(1096) t(i))""")
def m1_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar, with the orders of 2000 days before each day."""
    days = dims.dim_date(spark)
    n = A.load(spark, sf, "orders").groupBy(F.date_add(F.to_date("o_orderdate"), 2000).alias("date")).agg(F.count("*").alias("n_orders"))
    df = days.join(n, "date", "left")
    return df.select(F.col("date").cast("string").alias("date"), "date_key", "quarter", "day_of_week", "day_name", "month_name", "week_of_year", "is_weekend", "is_flu_season", "is_holiday", "fiscal_quarter_medical", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query("SELECT period_of_day, is_sleep_window, is_clinical_hours, count(*) AS n_events FROM (SELECT CASE WHEN h BETWEEN 5 AND 11 THEN 'morning' WHEN h BETWEEN 12 AND 16 THEN 'afternoon' WHEN h BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS period_of_day, h >= 22 OR h < 7 AS is_sleep_window, h BETWEEN 8 AND 16 AS is_clinical_hours FROM (SELECT hour(ts) AS h FROM events)) GROUP BY 1, 2, 3")
def m2_dim_time(spark: SparkSession, sf: str) -> DataFrame:
    e = A.load(spark, sf, "events").select(K.time_key("ts").alias("time_key"))
    return e.join(F.broadcast(dims.dim_time(spark)), "time_key").groupBy("period_of_day", "is_sleep_window", "is_clinical_hours").agg(F.count("*").alias("n_events"))


SEEDS = "(VALUES " + ", ".join(f"('{c}', '{n}', '{g}')" for c, n, g in dims.CONDITIONS) + ") t(code, name, category)"


@query(f"SELECT code AS condition_code, name AS condition_name, category AS category_name, {key('code')} AS condition_key, {key('category')} AS condition_category_key, count(o_orderkey) AS n FROM {SEEDS} LEFT JOIN (SELECT {CODE} AS k, o_orderkey FROM orders) ON k = code GROUP BY ALL")
def m4_dim_condition(spark: SparkSession, sf: str) -> DataFrame:
    d = dims.dim_condition(spark).join(dims.dim_condition_category(spark).select("condition_category_key", "category_name"), "condition_category_key")
    n = A.conditions(spark, sf).groupBy(F.col("icd10_code").alias("condition_code")).agg(F.count("*").alias("n"))
    return d.join(n, "condition_code", "left").select("condition_code", "condition_name", "category_name", "condition_key", "condition_category_key", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""WITH {PEOPLE}, {PATIENT}, {READINGS}, pc AS (SELECT c, code FROM (SELECT o_custkey AS c, {CODE} AS code, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), {CODE}) AS rn FROM orders WHERE o_orderstatus <> 'F') WHERE rn = 1),
dv AS (SELECT user_id AS c, count(DISTINCT device_id) AS n, min(CAST(event_timestamp AS DATE)) AS f FROM r WHERE user_id % 5 <> 0 GROUP BY 1)
SELECT patient_key, patient_id_masked, age_group, 'Unknown' AS gender, {key('code')} AS primary_condition_key, CAST(coalesce(n, 0) AS BIGINT) AS device_count, CAST(f AS VARCHAR) AS first_reading_date FROM po LEFT JOIN pc USING (c) LEFT JOIN dv USING (c)""")
def m8_dim_patient(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).dim_patient.withColumn("first_reading_date", F.col("first_reading_date").cast("string"))


@query(f"SELECT {key("sha256('u' || c_custkey || '@example.com')")} AS patient_key, sha256('mrn' || c_custkey) AS patient_id_masked, {AGE} AS age_group, 'Unknown' AS gender, CAST(NULL AS BIGINT) AS primary_condition_key, CAST(0 AS BIGINT) AS device_count, CAST(NULL AS VARCHAR) AS first_reading_date FROM customer WHERE c_custkey % 11 <> 0")
def m8_dim_patient_of_ehr(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension as it is built before there is a bridge; some addresses are written in two ways."""
    d = A.demographics(spark, sf)
    again = d.withColumn("patient_email", F.concat(F.lit(" "), F.upper("patient_email")))
    return dims.dim_patient_of_ehr(d.unionByName(again), 2024).withColumn("first_reading_date", F.col("first_reading_date").cast("string"))


@query(f"WITH {READINGS} SELECT device_key, device_id, min(device_type) AS device_type, firmware_version, {case('substr(device_id, 1, 2)', K.MODELS, 'Unknown')} AS model, CASE WHEN max(user_id) % 5 <> 0 THEN max(patient_key) END AS patient_key, CAST(min(CAST(event_timestamp AS DATE)) AS VARCHAR) AS registration_date FROM r GROUP BY device_key, device_id, firmware_version")
def m9_dim_device(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).dim_device.select("device_key", "device_id", "device_type", "firmware_version", "model", "patient_key", F.col("registration_date").cast("string").alias("registration_date"))


# facts


@query(f"WITH {READINGS}, {STATS} SELECT r.reading_key, r.patient_key, r.device_key, r.metric_key, r.date_key, r.time_key, r.metric_value, CAST(CASE WHEN r.is_late_arriving THEN 0.75 ELSE 1.0 END AS DOUBLE) AS quality_score, al.z IS NOT NULL AS is_anomaly, CASE WHEN al.z IS NOT NULL THEN {ALERT_TYPE} END AS anomaly_type FROM r LEFT JOIN (SELECT reading_key, z FROM al) al USING (reading_key) WHERE r.is_valid")
def n1_vital_readings(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf, stored=True)
    return facts.fact_vital_reading(w.readings, w.bridge, w.dim_metric, w.dim_device, w.fact_anomaly_alert)


LAB_FACT = f"""
lf AS (SELECT patient_id, {dkey('test_date')} AS date_key, test_code, max(value) AS value FROM lb GROUP BY ALL),
lg AS (SELECT *, CASE WHEN p.c IS NOT NULL THEN {key("sha256('u' || p.c || '@example.com')")} ELSE {key('patient_id')} END AS patient_key, {key("CASE test_code WHEN 'HbA1c' THEN 'E11.9' WHEN 'LDL' THEN 'E78.5' END")} AS condition_key, CASE test_code WHEN 'HbA1c' THEN 'E11.9' WHEN 'LDL' THEN 'E78.5' END AS code FROM lf LEFT JOIN cu p ON lf.patient_id = 'MRN' || p.c)"""


@query(f"WITH {PEOPLE}, {LABS}, {LAB_FACT} SELECT patient_key, date_key, test_code AS lab_test_name, value AS result_value, NOT value BETWEEN 10 AND 40 AS is_abnormal, condition_key FROM lg")
def n3_lab_results(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).fact_lab_result.select("patient_key", "date_key", "lab_test_name", "result_value", "is_abnormal", "condition_key")


@query(f"WITH {FILLS} SELECT {key('rx_id')} AS fill_key, {key('pharmacy_patient_id')} AS patient_key, {key('drug')} AS medication_key, date_key, 30 AS days_supply, refill_number, status FROM ff")
def n4_prescription_fills(spark: SparkSession, sf: str) -> DataFrame:
    return Warehouse(spark, sf).fact_prescription_fill


# views


@query(f"WITH {PEOPLE}, {PATIENT}, {READINGS}, {DAILY} SELECT d.patient_key, po.age_group, d.metric_name, d.date_key, round(d.avg_value + 1e-9, 4) AS avg_value, d.reading_count, CASE WHEN d.avg_value < 5 THEN 'below_normal' WHEN d.avg_value > 100 THEN 'above_normal' ELSE 'normal' END AS avg_status FROM d JOIN po ON d.patient_key = po.patient_key")
def v1_patient_vital_trends(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return view(spark, "patient_vital_trends", w.tables("fact_vital_daily_summary", "dim_metric", "dim_patient")).select("patient_key", "age_group", "metric_name", "date_key", r4("avg_value").alias("avg_value"), "reading_count", "avg_status")


@query(f"WITH {PEOPLE}, {PATIENT}, {READINGS}, {STATS}, {TRENDS}, {ALERTS} SELECT alert_key, aa.patient_key, po.age_group, metric_name, date_key, CAST(day AS VARCHAR) AS alert_date, alert_type, severity, round((metric_value - m) / nullif(m, 0) * 100 + 1e-9, 1) AS pct_deviation FROM aa JOIN po ON aa.patient_key = po.patient_key")
def v2_active_anomaly_alerts(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf, stored=True)
    return view(spark, "active_anomaly_alerts", w.tables("fact_anomaly_alert", "dim_metric", "dim_patient")).select("alert_key", "patient_key", "age_group", "metric_name", "date_key", F.col("alert_date").cast("string").alias("alert_date"), "alert_type", "severity", "pct_deviation")


@query(f"WITH {FILLS} SELECT {key('rx_id')} AS fill_key, drug AS medication_name, CAST(fill_date AS VARCHAR) AS fill_date, CASE WHEN refill_number = 0 THEN 'new_prescription' ELSE 'refill' END AS fill_type FROM ff WHERE drug IS NOT NULL")
def v3_medication_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """The pharmacy's patients are a namespace of their own, so each is given a row of the patient dimension."""
    w = Warehouse(spark, sf)
    t = w.tables("fact_prescription_fill", "dim_medication", "dim_drug_class")
    t["dim_patient"] = t["fact_prescription_fill"].select("patient_key", F.lit("Unknown").alias("age_group"), F.lit("Unknown").alias("gender")).distinct()
    return view(spark, "medication_timeline", t).select("fill_key", "medication_name", F.col("fill_date").cast("string").alias("fill_date"), "fill_type")


@query(f"WITH {PEOPLE}, {PATIENT}, {LABS}, {LAB_FACT} SELECT lg.patient_key, po.age_group, lg.date_key, test_code AS lab_test_name, value AS result_value, s.name AS condition_name, s.category AS condition_category, CASE WHEN value < 10 THEN 'low' WHEN value > 40 THEN 'high' ELSE 'normal' END AS result_status FROM lg JOIN po ON lg.patient_key = po.patient_key LEFT JOIN {SEEDS.replace(') t(', ') s(')} ON s.code = lg.code")
def v4_lab_results_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return view(spark, "lab_results_by_condition", w.tables("fact_lab_result", "dim_condition", "dim_condition_category", "dim_patient")).select("patient_key", "age_group", "date_key", "lab_test_name", "result_value", "condition_name", "condition_category", "result_status")


@query(f"WITH {PEOPLE}, {PATIENT}, {READINGS}, {DAILY} SELECT age_group, metric_name, date_key, count(DISTINCT d.patient_key) AS patient_count, round(avg(avg_value) + 1e-9, 2) AS cohort_avg, round(min(min_value), 2) AS cohort_min, round(max(max_value), 2) AS cohort_max, CAST(sum(reading_count) AS BIGINT) AS total_readings, CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies, round(avg(pct) + 1e-9, 1) AS avg_pct_in_normal_range FROM d JOIN po ON d.patient_key = po.patient_key GROUP BY 1, 2, 3")
def v5_population_analytics(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf, stored=True)
    return view(spark, "population_analytics", w.tables("fact_vital_daily_summary", "dim_metric", "dim_patient")).drop("gender", "unit", "normal_low", "normal_high", "reading_date")


# checks


@query(f"WITH {READINGS}, {PEOPLE}, t AS (SELECT 'silver' AS o, count(*) AS n FROM r UNION ALL SELECT 'bridge', 2 * (SELECT count(*) FROM cu) + (SELECT count(*) FROM ac)) SELECT 'row_count' AS \"check\", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n > 0 THEN 'ok' ELSE 'warn' END AS status FROM t")
def o1_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return checks.check_counts({"silver": w.readings, "bridge": w.bridge})


@query(f"""WITH {READINGS}, {PEOPLE}, {PATIENT}, {FILLS}, x AS (SELECT 'fact_prescription_fill.patient_key -> dim_patient' AS o, count(*) AS n FROM ff UNION ALL SELECT 'fact_prescription_fill.medication_key -> dim_medication', 0
UNION ALL SELECT 'dim_device.patient_key -> dim_patient', count(DISTINCT device_key) FROM r WHERE user_id % 5 <> 0 AND patient_key NOT IN (SELECT patient_key FROM po))
SELECT 'foreign_key' AS "check", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM x""")
def o2_foreign_keys(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_foreign_keys(Warehouse(spark, sf).tables("dim_device", "dim_patient", "fact_prescription_fill", "dim_medication"))


@query("SELECT 'not_null' AS \"check\", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM (SELECT 'events.metric_value' AS o, count(*) FILTER (event_id % 100 = 0 OR event_id % 97 = 0) AS n FROM events UNION ALL SELECT 'events.reading_id', 0)")
def o3_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_not_null({"events": A.readings(spark, sf)}, {"events": ["reading_id", "metric_value"]})


@query("SELECT 'grain' AS \"check\", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM (SELECT 'orders' AS o, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING count(*) > 1)) AS n UNION ALL SELECT 'customer', 0)")
def o5_grain(spark: SparkSession, sf: str) -> DataFrame:
    o = A.load(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return checks.check_grain({"orders": o, "customer": A.load(spark, sf, "customer")}, {"orders": ["o_custkey", "day"], "customer": ["c_custkey"]})


#: Where an application has written the gold tables of a folder of sources.
STORED_GOLD: dict[tuple[str, str], str] = {}


def _gold(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All gold tables, written once an application to the shared folder: the checks share them. The sources are taken as unchanging while it runs."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in STORED_GOLD:
        out = T.shared_folder(spark)
        run_pipeline(spark, sf, out)
        STORED_GOLD[key] = out
    return {n: spark.read.parquet(f"{STORED_GOLD[key]}/gold/{n}") for n in Warehouse.GOLD}


GOLD_SQL = f"""{READINGS}, {PEOPLE}, {PATIENT}, {LABS}, {FILLS}, {DAILY}, {STATS}, {LAB_FACT}, {TRENDS}, {ALERTS}"""
STATUS = "CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END"


@query(f"""WITH {GOLD_SQL}, x AS (SELECT unnest(['dim_condition_category', 'dim_drug_class', 'dim_metric', 'dim_condition', 'dim_medication', 'dim_date', 'dim_time']) AS o, unnest([{len(dims.CATEGORIES)}, {len(dims.DRUG_CLASSES)}, {len(A.METRICS)}, {len(dims.CONDITIONS)}, {len(dims.MEDICATIONS)}, 1096, 1440]) AS n
UNION ALL SELECT 'dim_patient', count(*) FROM po UNION ALL SELECT 'dim_device', count(DISTINCT device_key) FROM r UNION ALL SELECT 'fact_vital_reading', count(*) FROM r WHERE is_valid UNION ALL SELECT 'fact_vital_daily_summary', count(*) FROM d
UNION ALL SELECT 'fact_lab_result', count(*) FROM lg UNION ALL SELECT 'fact_prescription_fill', count(*) FROM ff UNION ALL SELECT 'fact_anomaly_alert', count(*) FROM aa)
SELECT 'row_count' AS "check", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN o IN ('{"', '".join(checks.EXPECTED_COUNTS)}') THEN CASE WHEN n = {case('o', checks.EXPECTED_COUNTS, '-1')} THEN 'ok' WHEN n = 0 THEN 'warn' ELSE 'fail' END WHEN n > 0 THEN 'ok' ELSE 'warn' END AS status FROM x""")
def o1_gold_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_counts(_gold(spark, sf) | {"dim_date": dims.dim_date(spark), "dim_time": dims.dim_time(spark)})


@query(f"""WITH {GOLD_SQL}, x AS (SELECT unnest(['dim_condition.condition_category_key -> dim_condition_category', 'dim_medication.drug_class_key -> dim_drug_class', 'fact_vital_reading.metric_key -> dim_metric', 'fact_vital_daily_summary.metric_key -> dim_metric', 'fact_prescription_fill.medication_key -> dim_medication', 'fact_anomaly_alert.metric_key -> dim_metric']) AS o, 0 AS n
UNION ALL SELECT 'dim_device.patient_key -> dim_patient', count(DISTINCT device_key) FROM r WHERE user_id % 5 <> 0 AND patient_key NOT IN (SELECT patient_key FROM po)
UNION ALL SELECT 'fact_vital_reading.patient_key -> dim_patient', count(*) FROM r WHERE is_valid AND patient_key NOT IN (SELECT patient_key FROM po)
UNION ALL SELECT 'fact_vital_daily_summary.patient_key -> dim_patient', count(*) FROM d WHERE patient_key NOT IN (SELECT patient_key FROM po)
UNION ALL SELECT 'fact_lab_result.patient_key -> dim_patient', count(*) FROM lg WHERE patient_key NOT IN (SELECT patient_key FROM po)
UNION ALL SELECT 'fact_prescription_fill.patient_key -> dim_patient', count(*) FROM (SELECT {key('pharmacy_patient_id')} AS patient_key FROM ff) WHERE patient_key NOT IN (SELECT patient_key FROM po)
UNION ALL SELECT 'fact_anomaly_alert.patient_key -> dim_patient', count(*) FROM aa WHERE patient_key NOT IN (SELECT patient_key FROM po))
SELECT 'foreign_key' AS "check", o AS object, CAST(n AS DOUBLE) AS value, {STATUS} AS status FROM x""")
def o2_gold_foreign_keys(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_foreign_keys(_gold(spark, sf))


@query(f"""WITH {GOLD_SQL}, x AS (SELECT unnest(['{"', '".join(f"{t}.{c}" for t, cols in checks.NOT_NULL.items() for c in cols if c not in ("avg_value", "result_value"))}']) AS o, 0 AS n
UNION ALL SELECT 'fact_vital_daily_summary.avg_value', count(*) FROM d WHERE avg_value IS NULL UNION ALL SELECT 'fact_lab_result.result_value', count(*) FROM lg WHERE value IS NULL)
SELECT 'not_null' AS "check", o AS object, CAST(n AS DOUBLE) AS value, {STATUS} AS status FROM x""")
def o3_gold_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_not_null(_gold(spark, sf))


@query(f"""WITH {GOLD_SQL}, x AS (SELECT unnest(['dim_patient', 'dim_device', 'dim_metric', 'fact_vital_reading', 'fact_vital_daily_summary', 'fact_prescription_fill']) AS o, 0 AS n
UNION ALL SELECT 'fact_lab_result', count(*) FROM (SELECT 1 FROM lg GROUP BY patient_key, date_key, test_code HAVING count(*) > 1))
SELECT 'grain' AS "check", o AS object, CAST(n AS DOUBLE) AS value, {STATUS} AS status FROM x""")
def o5_gold_grain(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_grain(_gold(spark, sf))


@query(f"WITH {READINGS} SELECT 'plausible' AS \"check\", metric_name AS object, CAST(sum(CASE WHEN metric_value > 120 THEN 1 ELSE 0 END) AS DOUBLE) AS value, CASE WHEN sum(CASE WHEN metric_value > 120 THEN 1 ELSE 0 END) = 0 THEN 'ok' ELSE 'warn' END AS status FROM r GROUP BY 2")
def o6_plausible(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_plausible(A.readings(spark, sf), {e: (0, 120) for e in A.DEVICE_OF})


@query(f"WITH {READINGS}, x AS (SELECT 'accounts' AS o, 100.0 * (SELECT count(DISTINCT user_id) FROM r WHERE user_id % 5 <> 0) / (SELECT count(DISTINCT user_id) FROM r) AS v UNION ALL SELECT 'readings', 100.0 * count(*) FILTER (user_id % 5 <> 0) / count(*) FROM r) SELECT o AS object, round(v + 1e-9, 4) AS value, CASE WHEN v >= 95 THEN 'ok' WHEN v >= 80 THEN 'warn' ELSE 'fail' END AS status FROM x")
def o8_identity_coverage(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return checks.identity_coverage(w.readings, w.bridge).select("object", r4("value").alias("value"), "status")


@query(f"WITH {READINGS}, {DAILY} SELECT 'lineage' AS \"check\", o AS object, CAST(n AS DOUBLE) AS value, 'info' AS status FROM (SELECT 'bronze' AS o, count(*) + count(*) FILTER (event_id % 50 = 0) AS n FROM events UNION ALL SELECT 'silver', count(*) FROM r UNION ALL SELECT 'gold daily', count(*) FROM d)")
def o9_lineage(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return checks.lineage({"bronze": A.bronze(A.load(spark, sf, "events")), "silver": w.readings, "gold daily": w.fact_vital_daily_summary})


@query(f"WITH {READINGS}, {STATS}, x AS (SELECT firmware_version AS o, count(*) AS n, count(z) AS a FROM r LEFT JOIN (SELECT reading_key, z FROM al) USING (reading_key) WHERE is_valid GROUP BY 1) SELECT 'firmware ' || o AS object, round(100.0 * a / n + 1e-9, 4) AS value, CASE WHEN 100.0 * a / n > 15 THEN 'investigate' ELSE 'ok' END AS status FROM x UNION ALL SELECT 'all', round(100.0 * sum(a) / sum(n) + 1e-9, 4), CASE WHEN 100.0 * sum(a) / sum(n) > 10 THEN 'warn_high' WHEN 100.0 * sum(a) / sum(n) > 5 THEN 'warn' ELSE 'ok' END FROM x")
def o10_anomaly_rate(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    return checks.anomaly_rate(w.fact_vital_reading, w.fact_anomaly_alert, w.dim_device).select("object", r4("value").alias("value"), "status")


@query("SELECT 'scd2' AS \"check\", unnest(['several_current', 'no_current', 'current_with_end', 'closed_without_end', 'overlap', 'gap', 'empty_version']) AS object, CAST(0 AS DOUBLE) AS value, 'ok' AS status")
def o11_scd2_audit(spark: SparkSession, sf: str) -> DataFrame:
    return checks.audit_scd2(_scd2(spark, sf), ["patient"])


@query(f"WITH {READINGS} SELECT device_type, metric_name, is_valid, is_late_arriving, count(*) AS n FROM r GROUP BY 1, 2, 3, 4")
def o15_silver_profile(spark: SparkSession, sf: str) -> DataFrame:
    return checks.silver_profile(A.readings(spark, sf))


@query("SELECT 'invariant' AS \"check\", unnest(['avg within min and max', 'reading_count positive']) AS object, CAST(0 AS DOUBLE) AS value, 'ok' AS status")
def o16_invariants(spark: SparkSession, sf: str) -> DataFrame:
    return checks.summary_invariants(Warehouse(spark, sf).fact_vital_daily_summary)


@query(r"""SELECT 'personal_value' AS "check", 'documents.' || c || ' ' || k AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM (
SELECT c, k, count(*) FILTER (regexp_matches(v, p)) AS n FROM (SELECT unnest(['text', 'lang', 'source']) AS c, unnest([text, lang, source]) AS v FROM documents), (VALUES ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}'), ('phone', '\+[0-9][0-9 ().-]{8,}[0-9]'), ('ssn', '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b')) t(k, p) GROUP BY c, k)""")
def o18_personal_values(spark: SparkSession, sf: str) -> DataFrame:
    return checks.personal_values(A.load(spark, sf, "documents"), "documents")


# streams


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.file_source(spark, f"{sf}/events.parquet*", A.load(spark, sf, "events").schema)


@query("SELECT CAST(user_id % 6 AS INTEGER) AS kafka_partition, count(*) + count(*) FILTER (event_id % 50 = 0) AS n FROM events GROUP BY 1")
def i2_drain_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream of messages into partitioned bronze files, drained."""
    out = T.shared_folder(spark)
    q = ingest.append_stream(T.to_bronze(A.event_messages(_stream(spark, sf)), F.col("timestamp")), f"{out}/bronze", f"{out}/checkpoint", partition_by=("ingestion_date",))
    q.awaitTermination()
    return spark.read.parquet(f"{out}/bronze").groupBy("kafka_partition").agg(F.count("*").alias("n"))


@query(f"WITH {READINGS} SELECT reading_id, metric_value, is_valid, is_late_arriving FROM r")
def i4_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream of several files, upserted to silver batch by batch; the first arrival wins over batches too."""
    out = T.shared_folder(spark)
    events = A.load(spark, sf, "events")
    events.repartition(4).write.parquet(f"{out}/in")
    stream = ingest.file_source(spark, f"{out}/in", events.schema, files_per_batch=2)
    ingest.upsert_stream(T.to_bronze(A.event_messages(stream), F.col("timestamp")), A.to_silver, f"{out}/silver", f"{out}/checkpoint").awaitTermination()
    silver = ingest.first_arrivals(spark, f"{out}/silver", ["reading_id", "metric_name"], "sync_timestamp", "ingestion_timestamp")
    return silver.select("reading_id", "metric_value", "is_valid", "is_late_arriving")


def _change_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Change envelopes as a broker gives them, one for each order; every seventh has no row."""
    o = A.load(spark, sf, "orders")
    op = F.when(F.col("o_orderkey") % 10 == 0, "d").when(F.col("o_orderkey") % 2 == 0, "u").otherwise("c")
    row = F.struct(F.col("o_orderkey").cast("string").alias("rx_id"), F.concat(F.lit("PH"), F.col("o_custkey")).alias("pharmacy_patient_id"), F.col("o_orderstatus").alias("status"), F.lit(30).alias("days_supply"))
    none = F.lit(None).cast("struct<rx_id:string,pharmacy_patient_id:string,status:string,days_supply:int>")
    gone = F.col("o_orderkey") % 7 == 0
    body = F.struct(op.alias("op"), F.when((op == "d") & ~gone, row).otherwise(none).alias("before"), F.when((op != "d") & ~gone, row).otherwise(none).alias("after"), (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000).alias("ts_ms"))
    m = o.select(F.to_json(body).alias("value"), F.lit("pharmacy").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    return T.to_bronze(m, F.col("timestamp"))


@query("SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'd' WHEN o_orderkey % 2 = 0 THEN 'u' ELSE 'c' END AS op, CAST(o_orderkey AS VARCHAR) AS rx_id, 'PH' || o_custkey AS pharmacy_patient_id, o_orderstatus AS status, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS ts_ms FROM orders WHERE o_orderkey % 7 <> 0")
def b4_parse_changes(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_changes(_change_messages(spark, sf)).select("op", "rx_id", "pharmacy_patient_id", "status", "ts_ms")


def _patients(spark: SparkSession, sf: str) -> DataFrame:
    """Clinical bundles from orders: a patient's entries of a day, of three resource types."""
    o = A.load(spark, sf, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "Condition").when(F.col("o_orderkey") % 3 == 1, "MedicationStatement").otherwise("Observation")
    names = [x.split(" ")[0] for x in T.ENTRY.split(", ")]
    own = {"resource_type": kind, "code": F.element_at(F.array(*[F.lit(c) for c in A.CODES]), (F.col("o_orderkey") % 7 + 1).cast("int")), "status": F.col("o_orderstatus"), "onset_date": F.date_format("o_orderdate", "yyyy-MM-dd"), "start_date": F.date_format("o_orderdate", "yyyy-MM-dd"), "medication": F.lit("metformin"), "dosage": F.col("o_orderpriority"), "value": F.col("o_totalprice"), "date": F.date_format("o_orderdate", "yyyy-MM-dd")}
    types = dict(x.split(" ") for x in T.ENTRY.split(", "))
    entry = F.struct(*[own.get(n, F.lit(None)).cast(types[n]).alias(n) for n in names])
    return o.groupBy(F.concat(F.lit("MRN"), F.col("o_custkey")).alias("patient_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("batch_date")).agg(F.collect_list(entry).alias("entries")).withColumn("patient_email", F.lit("x@example.com"))


@query("WITH e AS (SELECT 'MRN' || o_custkey AS patient_id, o_orderkey % 3 AS k, ['E11.9', 'I10', 'J45.20', 'E78.5', 'F32.1', 'M54.5', 'K21.0'][o_orderkey % 7 + 1] AS code, o_orderstatus AS status, o_orderpriority AS dosage, o_totalprice AS value, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders) SELECT 'condition' AS resource, patient_id, code AS item, status AS detail, day, sha256(status || '||' || code) AS hash FROM e WHERE k = 0 UNION ALL SELECT 'medication', patient_id, 'metformin', dosage, day, sha256(status || '||' || dosage || '||') FROM e WHERE k = 1 UNION ALL SELECT 'lab', patient_id, code, CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR), day, NULL FROM e WHERE k = 2")
def b6_clinical_resources(spark: SparkSession, sf: str) -> DataFrame:
    p = _patients(spark, sf)
    c = parse.conditions(p).select(F.lit("condition").alias("resource"), "patient_id", F.col("icd10_code").alias("item"), F.col("status").alias("detail"), F.col("onset_date").cast("string").alias("day"), F.col("row_hash").alias("hash"))
    m = parse.medications(p).select(F.lit("medication").alias("resource"), "patient_id", F.col("medication").alias("item"), F.col("dosage").alias("detail"), F.col("effective_start").cast("string").alias("day"), F.col("row_hash").alias("hash"))
    text = F.col("value").cast("decimal(18,2)").cast("string")
    x = parse.labs(p).select(F.lit("lab").alias("resource"), "patient_id", F.col("test_code").alias("item"), text.alias("detail"), F.col("test_date").cast("string").alias("day"), F.lit(None).cast("string").alias("hash"))
    return c.unionByName(m).unionByName(x)


@query("SELECT CASE o_orderkey % 3 WHEN 0 THEN 'Condition' WHEN 1 THEN 'MedicationStatement' ELSE 'Observation' END AS resource_type, count(*) AS entries, count(DISTINCT o_custkey) AS patients FROM orders GROUP BY 1")
def o17_bundle_profile(spark: SparkSession, sf: str) -> DataFrame:
    return parse.bundle_profile(_patients(spark, sf)).select("resource_type", "entries", "patients")


@query(f"""WITH vb AS (SELECT o_custkey * 10 + (o_custkey * 3 + o_orderkey) % 7 AS patient, CAST(o_orderdate AS DATE) AS batch_date, CASE o_orderstatus WHEN 'F' THEN 'resolved' ELSE 'active' END AS status, '' AS dosage, o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'resolved' ELSE 'active' END AS row_hash FROM orders), {HISTORY.format(n='h', where='TRUE')}
SELECT 'MRN' || (patient // 10) AS patient_id, ['{"', '".join(A.CODES)}'][patient % 10 + 1] AS icd10_code, status, CAST(effective_start AS VARCHAR) AS effective_start, CAST(effective_end AS VARCHAR) AS effective_end FROM h""")
def k8_condition_history(spark: SparkSession, sf: str) -> DataFrame:
    df = scd.history(A.conditions(spark, sf), ["patient_id", "icd10_code"], "onset_date", "status", ["seq"])
    return df.select("patient_id", "icd10_code", "status", F.col("effective_start").cast("string").alias("effective_start"), F.col("effective_end").cast("string").alias("effective_end"))


MEDS = "(VALUES " + ", ".join(f"('{m}', '{g}', '{c}')" for m, g, c in dims.MEDICATIONS) + ") t(name, generic, class)"


@query(f"WITH {FILLS} SELECT name AS medication_name, generic AS generic_name, class AS class_name, {key('name')} AS medication_key, count(rx_id) AS fills FROM {MEDS} LEFT JOIN ff ON drug = name GROUP BY ALL")
def m6_dim_medication(spark: SparkSession, sf: str) -> DataFrame:
    w = Warehouse(spark, sf)
    d = w.dim_medication.join(w.dim_drug_class, "drug_class_key")
    n = w.fact_prescription_fill.groupBy("medication_key").agg(F.count("*").alias("fills"))
    return d.join(n, "medication_key", "left").select("medication_name", "generic_name", "class_name", "medication_key", F.coalesce("fills", F.lit(0)).alias("fills"))


@query("WITH x AS (SELECT 'events' AS t, max(ts) AS m, 24 AS sla FROM events UNION ALL SELECT 'orders', max(o_orderdate), 24 FROM orders) SELECT t AS \"table\", round((CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - CAST(floor(epoch(m)) AS BIGINT)) / 3600 + 1e-9, 4) AS hours, CASE WHEN (CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - CAST(floor(epoch(m)) AS BIGINT)) / 3600 <= sla THEN 'ok' ELSE 'stale' END AS status FROM x")
def o7_freshness(spark: SparkSession, sf: str) -> DataFrame:
    e = A.load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    o = A.load(spark, sf, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))
    return T.freshness({"events": (e, "ts"), "orders": (o, "ts")}, {"events": 24, "orders": 24}, F.lit("2024-01-31").cast("timestamp")).select("table", r4("hours").alias("hours"), "status")


@query("SELECT event_type, count(*) AS n, round(100.0 * count(*) FILTER (value > 100) / nullif(count(*) FILTER (value < 50), 0) + 1e-9, 4) AS ratio FROM events GROUP BY 1")
def d11_guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    e = A.load(spark, sf, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.when(F.col("value") > 100, 1)).alias("a"), F.count(F.when(F.col("value") < 50, 1)).alias("b")).select("event_type", "n", r4(100 * F.try_divide("a", "b")).alias("ratio"))


@query("SELECT DISTINCT kind, id FROM (SELECT 'customer' AS kind, o_custkey AS id FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer UNION ALL SELECT 'supplier', l_suppkey FROM lineitem)")
def g1_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda kind, t, c: A.load(spark, sf, t).select(F.lit(kind).alias("kind"), F.col(c).alias("id"))
    return of("customer", "orders", "o_custkey").unionByName(of("customer", "customer", "c_custkey")).unionByName(of("supplier", "lineitem", "l_suppkey")).distinct()


@query("SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '2000-01-01' GROUP BY 1")
def a15_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as bronze partitions by day's year, replayed from a date; only the partitions since then are read."""
    out = T.shared_folder(spark)
    li = A.load(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_quantity", F.date_format("l_shipdate", "yyyy").alias("ingestion_date"))
    T.overwrite(T.compact(li, 4, ["day"]), f"{out}/bronze", ["ingestion_date"])
    return T.replay(spark, f"{out}/bronze", "2000", lambda df: df.groupBy("day").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")))


from . import further, upkeep  # noqa: E402, F401 - they add their queries
