"""More queries: files and topics, sorted and limited reports, the whole metric dimension, further columns and versions, audits of planted defects, the stateful detector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import keys as K
from pulsegrid.operators import checks, dims, quality, scd, windows
from pulsegrid.sources import adapter as A
from pulsegrid.sources import tables as T
from pulsegrid.streaming import ingest

from .queries import CODE, DAILY, FILLS, HISTORY, READINGS, _patients, _stream, key, query, r4
from .warehouse import Warehouse

KIND = "CASE o_orderkey % 3 WHEN 0 THEN 'Condition' WHEN 1 THEN 'MedicationStatement' ELSE 'Observation' END"


def _ehr_files(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles of orders as JSON batches, one in a line, read by the reader of clinical batches; their dates are in the files."""
    out = T.shared_folder(spark)
    who = F.regexp_extract("patient_id", "([0-9]+)", 1)
    p = _patients(spark, sf).withColumn("patient_email", F.concat(F.lit("u"), who, F.lit("."), F.col("batch_date"), F.lit("@example.com"))).withColumn("patient_birth_year", (F.lit(1935) + who.cast("int") % 85).cast("int"))
    patient = F.struct("patient_id", "patient_email", "patient_birth_year", "entries")
    p.select(F.array(patient).alias("patients"), F.lit(1).alias("patient_count"), "batch_date").write.json(f"{out}/ehr")
    return T.read_ehr(spark, f"{out}/ehr/*.json", multi_line=False)


@query(f"SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS batch_date, {KIND} AS resource_type, count(*) AS entries, count(DISTINCT o_custkey) AS patients FROM orders GROUP BY 1, 2")
def a5_ehr_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _ehr_files(spark, sf).select("batch_date", "patient_id", F.explode("entries").alias("e")).groupBy("batch_date", F.col("e.resource_type").alias("resource_type")).agg(F.count("*").alias("entries"), F.countDistinct("patient_id").alias("patients"))


@query("SELECT 'MRN' || o_custkey AS patient_id, 'u' || o_custkey || '.' || max(CAST(o_orderdate AS DATE)) || '@example.com' AS patient_email, CAST(1935 + o_custkey % 85 AS INTEGER) AS patient_birth_year FROM orders GROUP BY o_custkey")
def a6_demographics(spark: SparkSession, sf: str) -> DataFrame:
    return T.demographics(_ehr_files(spark, sf))


@query("SELECT event_type AS activity, CASE event_id % 3 WHEN 0 THEN 'watch' WHEN 1 THEN 'phone' ELSE 'manual' END AS source, count(*) AS n, count(DISTINCT user_id) AS accounts, CAST(sum(event_id % 90) AS DOUBLE) AS minutes FROM events GROUP BY 1, 2")
def a17_activity_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages of the activity topic among others, parsed."""
    e = A.load(spark, sf, "events")
    at = F.col("ts").cast("timestamp")
    source = F.element_at(F.array(F.lit("watch"), F.lit("phone"), F.lit("manual")), (F.col("event_id") % 3 + 1).cast("int"))
    m = F.struct(F.col("event_id").cast("string").alias("session_id"), F.concat(F.lit("acct_"), F.col("user_id")).alias("device_account_id"), F.col("event_type").alias("activity"), source.alias("source"), at.alias("start"), (F.col("event_id") % 90).cast("double").alias("minutes"))
    topic = F.explode(F.array(F.lit("fitness_activities"), F.lit("device_registry")))
    # a generator beside the struct would take its fields' names away
    messages = e.select(F.to_json(m).alias("value"), "event_id", "ts").select("value", topic.alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), at.alias("timestamp"))
    got = T.parse_topic(T.to_bronze(messages, F.col("timestamp")), "fitness_activities", T.ACTIVITY)
    return got.groupBy("activity", "source").agg(F.count("*").alias("n"), F.countDistinct("device_account_id").alias("accounts"), F.sum("minutes").alias("minutes"))


@query(f"WITH {READINGS} SELECT device_type, metric_name, count(*) AS n FROM r GROUP BY 1, 2 ORDER BY n DESC, device_type, metric_name")
def f1_sorted_profile(spark: SparkSession, sf: str) -> DataFrame:
    return windows.most_first(A.readings(spark, sf).groupBy("device_type", "metric_name").agg(F.count("*").alias("n")), "n", "device_type", "metric_name")


@query("SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def f2_newest_events(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the 20 newest events."""
    return windows.newest(A.load(spark, sf, "events"), 20, "ts", "event_id").select("event_id", "event_type", "value")


ROWS = ", ".join(f"({k}, '{m}', '{u}', {low}, {high}, '{d}', {quality.VALID_BOUNDS[m][0]}, {quality.VALID_BOUNDS[m][1]})" for k, (m, u, low, high, d) in enumerate(dims.METRICS))


@query(f"""SELECT metric_name, device_type, unit, CAST(low AS DOUBLE) AS normal_low, CAST(high AS DOUBLE) AS normal_high, {key("metric_name || '|' || device_type")} AS metric_key, count(*) AS n, count(*) FILTER (value * 2 BETWEEN a AND b) AS n_valid, count(*) FILTER (value * 2 BETWEEN low AND high) AS n_normal
FROM events JOIN (VALUES {ROWS}) t(k, metric_name, unit, low, high, device_type, a, b) ON event_id % {len(dims.METRICS)} = k GROUP BY ALL""")
def m7_dim_metric(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of all metrics of all devices, flagged by the dimension's and the plausible bounds."""
    names = F.array(*[F.struct(F.lit(m).alias("metric_name"), F.lit(d).alias("device_type")) for m, _, _, _, d in dims.METRICS])
    e = A.load(spark, sf, "events").select(F.element_at(names, (F.col("event_id") % len(dims.METRICS) + 1).cast("int")).alias("x"), (F.col("value") * 2).alias("metric_value")).select("x.*", "metric_value")
    df = quality.flag_normal(quality.flag_valid(e).join(dims.dim_metric(spark), ["metric_name", "device_type"]), "metric_value", "normal_low", "normal_high")
    return df.groupBy("metric_name", "device_type", "unit", "normal_low", "normal_high", "metric_key").agg(F.count("*").alias("n"), F.count_if("is_valid").alias("n_valid"), F.count_if("in_normal_range").alias("n_normal"))


@query("""SELECT CAST(d AS VARCHAR) AS day, round(24 / pi() * acos(greatest(-1.0, least(1.0, -tan(radians(40.0)) * tan(0.409 * sin(2 * pi() * dayofyear(d) / 365 - 1.39))))) + 1e-9, 2) AS daylight_hours, month(d) IN (3, 4, 5, 6) AS is_allergy_season, n
FROM (SELECT CAST(o_orderdate AS DATE) + 2000 AS d, count(*) AS n FROM orders GROUP BY 1) WHERE d BETWEEN DATE '1992-01-01' AND DATE '2006-12-31'""")
def m10_daylight(spark: SparkSession, sf: str) -> DataFrame:
    days = dims.with_daylight(dims.dim_date(spark, "1992-01-01", 5479))
    n = A.load(spark, sf, "orders").groupBy(F.date_add(F.to_date("o_orderdate"), 2000).alias("date")).agg(F.count("*").alias("n"))
    return n.join(days, "date").select(F.col("date").cast("string").alias("day"), "daylight_hours", "is_allergy_season", "n")


@query(f"WITH {READINGS} SELECT metric_name, device_type, CAST(-4.5 AS DOUBLE) AS critical_low, CAST(109.5 AS DOUBLE) AS critical_high, count(*) FILTER (metric_value > 109.5 OR metric_value < -4.5) AS n_critical, count(*) AS n FROM r GROUP BY 1, 2")
def m10_critical_readings(spark: SparkSession, sf: str) -> DataFrame:
    metrics = dims.with_critical_bounds(dims.dim_metric(spark, A.METRICS))
    df = A.readings(spark, sf).join(metrics, ["metric_name", "device_type"])
    beyond = (F.col("metric_value") > F.col("critical_high")) | (F.col("metric_value") < F.col("critical_low"))
    return df.groupBy("metric_name", "device_type", r4("critical_low").alias("critical_low"), r4("critical_high").alias("critical_high")).agg(F.count_if(beyond).alias("n_critical"), F.count("*").alias("n"))


@query(f"SELECT code IN ('{"', '".join(dims.CHRONIC)}') AS is_chronic, count(*) AS n, count(DISTINCT o_custkey) AS patients FROM (SELECT {CODE} AS code, o_custkey FROM orders) GROUP BY 1")
def m10_chronic_conditions(spark: SparkSession, sf: str) -> DataFrame:
    d = dims.with_chronic(dims.dim_condition(spark)).select(F.col("condition_code").alias("icd10_code"), "is_chronic")
    return A.conditions(spark, sf).join(d, "icd10_code").groupBy("is_chronic").agg(F.count("*").alias("n"), F.countDistinct("patient_id").alias("patients"))


CLASS_OF = "(VALUES " + ", ".join(f"('{m.lower()}', '{c}')" for m, _, c in dims.MEDICATIONS) + ") t(drug, class_name)"


@query(f"WITH {FILLS} SELECT class_name, class_name IN ('{"', '".join(dims.MONITORED)}') AS requires_monitoring, count(*) AS n, count(DISTINCT pharmacy_patient_id) AS patients FROM ff JOIN {CLASS_OF} USING (drug) GROUP BY 1, 2")
def m10_monitored_fills(spark: SparkSession, sf: str) -> DataFrame:
    """Fills by drug class, and whether the class needs regular laboratory control."""
    classes = dims.with_monitoring(dims.dim_drug_class(spark)).select("drug_class_key", "class_name", "requires_monitoring")
    drugs = dims.dim_medication(spark).select("medication_key", "drug_class_key").join(classes, "drug_class_key")
    by = Warehouse(spark, sf).fact_prescription_fill.join(drugs, "medication_key").groupBy("class_name", "requires_monitoring")
    return by.agg(F.count("*").alias("n"), F.countDistinct("patient_key").alias("patients"))


ASSIGNED = """
vb AS (SELECT l_suppkey AS patient, CAST(l_shipdate AS DATE) AS batch_date, 'v' || (l_linenumber % 3) AS status, 'acct_' || (l_partkey % 5) AS dosage, (l_orderkey * 8 + l_linenumber) * 100000007 + l_partkey AS seq, sha256('v' || (l_linenumber % 3) || '||' || 'acct_' || (l_partkey % 5)) AS row_hash FROM lineitem)"""


@query(f"WITH {ASSIGNED}, {HISTORY.format(n='h', where='TRUE')} SELECT patient AS device, status AS firmware_version, dosage AS device_account_id, CAST(effective_start AS VARCHAR) AS effective_start, CAST(effective_end AS VARCHAR) AS effective_end FROM h")
def k7_device_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """A device's versions: a change of firmware or of the account opens one."""
    li = A.load(spark, sf, "lineitem")
    df = li.select(F.col("l_suppkey").alias("device"), F.to_date("l_shipdate").alias("day"), F.concat(F.lit("v"), F.col("l_linenumber") % 3).alias("firmware_version"), F.concat(F.lit("acct_"), F.col("l_partkey") % 5).alias("device_account_id"), ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000007 + F.col("l_partkey")).alias("seq"))
    df = scd.history(df.withColumn("row_hash", K.row_hash("firmware_version", "device_account_id")), ["device"], "day", "row_hash", ["seq"])
    return df.select("device", "firmware_version", "device_account_id", F.col("effective_start").cast("string").alias("effective_start"), F.col("effective_end").cast("string").alias("effective_end"))


@query("""SELECT 'erasure' AS "check", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM (SELECT unnest(['erased.c_name', 'erased.c_mktsegment', 'forgotten.c_name']) AS o, unnest([0, 0, (SELECT count(c_name) FROM customer WHERE c_custkey % 13 = 0)]) AS n)""")
def k9_erasure_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of erased people in a table that was erased and in a copy that was forgotten."""
    c = A.load(spark, sf, "customer")
    people = c.filter("c_custkey % 13 = 0").select("c_custkey")
    personal = ["c_name", "c_mktsegment"]
    return scd.erasure_sweep({"erased": scd.erase(c, people, "c_custkey", personal), "forgotten": c}, people, "c_custkey", {"erased": personal, "forgotten": ["c_name"]})


DEFECTS = """
hv AS (SELECT patient, CAST(effective_start AS DATE) AS s, CAST(effective_end AS DATE) AS e, effective_end IS NULL AS live FROM h),
x AS (SELECT patient, s, CASE patient % 20 WHEN 2 THEN coalesce(e, s) WHEN 3 THEN e + 1 WHEN 4 THEN e - 1 ELSE e END AS e, CASE patient % 20 WHEN 1 THEN FALSE WHEN 5 THEN TRUE ELSE live END AS live FROM hv),
y AS (SELECT *, coalesce(s < max(coalesce(e, DATE '9999-12-31')) OVER (PARTITION BY patient ORDER BY s, e NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS overlap, coalesce(lead(s) OVER (PARTITION BY patient ORDER BY s, e NULLS LAST) > e, FALSE) AS gap FROM x),
z AS (SELECT patient, count(*) FILTER (live) AS live, count(*) FILTER (live AND e IS NOT NULL) AS a, count(*) FILTER (NOT live AND e IS NULL) AS b, count(*) FILTER (overlap) AS c, count(*) FILTER (gap) AS d, count(*) FILTER (e <= s) AS f FROM y GROUP BY patient),
t AS (SELECT unnest(['several_current', 'no_current', 'current_with_end', 'closed_without_end', 'overlap', 'gap', 'empty_version']) AS o, unnest([count(*) FILTER (live > 1), count(*) FILTER (live = 0), CAST(sum(a) AS BIGINT), CAST(sum(b) AS BIGINT), CAST(sum(c) AS BIGINT), CAST(sum(d) AS BIGINT), CAST(sum(f) AS BIGINT)]) AS n FROM z)"""
VERSIONS = """
vb AS (SELECT o_custkey AS patient, CAST(o_orderdate AS DATE) AS batch_date, o_orderstatus AS status, o_orderpriority AS dosage, o_orderkey AS seq, sha256(o_orderstatus || '||' || o_orderpriority) AS row_hash FROM orders)"""


@query(f"""WITH {VERSIONS}, {HISTORY.format(n='h', where='TRUE')}, {DEFECTS} SELECT 'scd2' AS "check", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' WHEN o IN ('closed_without_end', 'gap', 'no_current') THEN 'warn' ELSE 'fail' END AS status FROM t""")
def o11_scd2_defects(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of a history in which each kind of defect was planted."""
    h = scd.history(A.versions(spark, sf), ["patient"], "batch_date", "row_hash", ["seq"])
    k, e = F.col("patient") % 20, F.col("effective_end")
    end = F.when(k == 2, F.coalesce(e, "effective_start")).when(k == 3, F.date_add(e, 1)).when(k == 4, F.date_sub(e, 1)).otherwise(e)
    live = F.when(k == 1, False).when(k == 5, True).otherwise(F.col("is_current"))
    return checks.audit_scd2(h.withColumn("is_current", live).withColumn("effective_end", end), ["patient"])


@query(f"""WITH {READINGS}, {DAILY} SELECT 'invariant' AS "check", o AS object, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status FROM (SELECT unnest(['avg within min and max', 'reading_count positive']) AS o, unnest([(SELECT count(*) FROM d WHERE date_key % 7 = 0 AND max_value IS NOT NULL), (SELECT count(*) FROM d WHERE date_key % 11 = 0)]) AS n)""")
def o16_invariant_defects(spark: SparkSession, sf: str) -> DataFrame:
    """The invariants of a daily summary with wrong means on some days and counts of 0 on others."""
    d = Warehouse(spark, sf).fact_vital_daily_summary
    d = d.withColumn("avg_value", F.when(F.col("date_key") % 7 == 0, F.col("max_value") + 1).otherwise(F.col("avg_value")))
    return checks.summary_invariants(d.withColumn("reading_count", F.when(F.col("date_key") % 11 == 0, 0).otherwise(F.col("reading_count"))))


@query("""SELECT 'personal_column' AS "check", o AS object, CAST(1 AS DOUBLE) AS value, 'fail' AS status FROM (SELECT unnest(['people.email', 'people.phone']) AS o) WHERE (SELECT count(*) FROM customer) >= 0""")
def o4_personal_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The gold tables' columns, and those of a table of people with their addresses."""
    people = A.load(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("email"), F.col("c_acctbal").alias("phone"))
    return checks.check_personal_columns(spark, Warehouse(spark, sf).tables() | {"people": people})


@query("SELECT CAST(0 AS BIGINT) AS batch, CAST(count(*) AS DOUBLE) AS rows FROM events")
def o19_stream_health(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of a drain of events, as the query's progress has them."""
    out = T.shared_folder(spark)
    q = ingest.append_stream(_stream(spark, sf).withColumn("ingestion_date", F.to_date("ts")), f"{out}/bronze", f"{out}/checkpoint", partition_by=("ingestion_date",))
    q.awaitTermination()
    return checks.stream_health(spark, [p for p in q.recentProgress if p["numInputRows"]]).select("batch", "rows")


@query(f"""WITH {READINGS}, v AS (SELECT device_account_id AS account, metric_name AS metric, event_id AS seq, metric_value AS value, count(*) OVER w AS n, avg(metric_value) OVER w AS mean, stddev_samp(metric_value) OVER w AS std FROM r WHERE is_valid
WINDOW w AS (PARTITION BY device_account_id, metric_name ORDER BY event_s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT account, metric, seq, value, round(mean + 1e-9, 4) AS mean, round(std + 1e-9, 4) AS std FROM v WHERE n >= 5 AND std > 0 AND abs(value - mean) > 2 * std""")
def i5_stateful_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Silver readings as a stream of files through the stateful detector; the given events all lie within its 30 days."""
    out = T.shared_folder(spark)
    r = A.readings(spark, sf).filter("is_valid").select(F.col("device_account_id").alias("account"), F.col("metric_name").alias("metric"), F.col("reading_id").cast("long").alias("seq"), F.unix_timestamp("event_timestamp").alias("event_s"), F.col("metric_value").alias("value"))
    r.write.parquet(f"{out}/in")
    alerts = ingest.baseline_alerts(ingest.file_source(spark, f"{out}/in", r.schema))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/alerts/batch={number}")

    ingest.alert_stream(alerts, keep, f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(ingest.ALERTS).parquet(f"{out}/alerts").select("account", "metric", "seq", "value", r4("mean").alias("mean"), r4("std").alias("std"))


@query("SELECT 'acct_' || user_id AS device_account_id, 'DEV-' || user_id AS device_id, 'u' || user_id || '@example.com' AS email, CAST(floor(epoch(min(ts))) AS BIGINT) AS registered_s FROM events GROUP BY user_id")
def a17_registry_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Registrations as messages of the registry topic, one with each event, parsed; the first of each account counts."""
    at, user = F.col("ts").cast("timestamp"), F.col("user_id").cast("string")
    m = F.struct(F.concat(F.lit("acct_"), user).alias("device_account_id"), F.concat(F.lit("DEV-"), user).alias("device_id"), F.concat(F.lit("u"), user, F.lit("@example.com")).alias("email"), at.alias("registered"))
    messages = A.load(spark, sf, "events").select(F.to_json(m).alias("value"), F.lit("device_registry").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), at.alias("timestamp"))
    got = T.parse_topic(T.to_bronze(messages, F.col("timestamp")), "device_registry", T.REGISTRY)
    return got.groupBy("device_account_id", "device_id", "email").agg(F.unix_timestamp(F.min("registered")).alias("registered_s"))


@query("SELECT 'orders' AS name, o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 2, 3 UNION ALL SELECT 'missing', NULL, NULL, 0")
def a8_overwritten_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, overwritten by a version with a further column and another layout; and a table without upstream, written empty with its types."""
    out = T.shared_folder(spark)
    orders = A.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    T.overwrite(orders.drop("o_orderpriority"), f"{out}/orders")
    T.overwrite(orders, f"{out}/orders", ["o_orderstatus"])
    T.overwrite(T.or_empty(T.read_table(spark, f"{out}/missing"), spark, orders.schema), f"{out}/missing")
    each = T.read_table(spark, f"{out}/orders").groupBy(F.lit("orders").alias("name"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))
    none = T.read_table(spark, f"{out}/missing").agg(F.max("o_orderstatus").alias("status"), F.max("o_orderpriority").alias("priority"), F.count("*").alias("n"))
    return each.unionByName(none.withColumn("name", F.lit("missing")))


@query("SELECT CAST(user_id % 6 AS INTEGER) AS kafka_partition, count(*) AS n, CAST(sum(event_id * 2 + x) AS BIGINT) AS sum_offset FROM events, (SELECT unnest([0, 1]) AS x) WHERE x = 0 OR event_id % 50 = 0 GROUP BY 1")
def i1_continuous_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Events through the continuous bronze sink, which is stopped and started again while files arrive; every message is there once."""
    out = T.shared_folder(spark)
    events = A.load(spark, sf, "events")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for k in (0, 1):
        T.append(events.filter(half == k), f"{out}/in")
        messages = A.event_messages(ingest.file_source(spark, f"{out}/in", events.schema, files_per_batch=4))
        q = ingest.bronze_stream(messages, f"{out}/bronze", f"{out}/checkpoint", every="1 second")
        q.processAllAvailable()
        q.stop()
    return spark.read.parquet(f"{out}/bronze").groupBy("kafka_partition").agg(F.count("*").alias("n"), F.sum("kafka_offset").alias("sum_offset"))


@query(f"WITH {READINGS} SELECT date_key, count(*) AS n, count(*) FILTER (is_late_arriving) AS n_late, count(*) FILTER (lag_s > {quality.VERY_LATE_SECONDS}) AS n_very_late FROM r GROUP BY 1")
def i7_late_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that were synced late or again come in a later run of the upsert than the others, some beyond 48 hours: all are flagged, none is dropped."""
    out = T.shared_folder(spark)
    messages = A.event_messages(A.load(spark, sf, "events"))
    at = lambda name: F.get_json_object("value", f"$.{name}_timestamp")
    for late in (False, True):
        T.append(messages.filter((at("event") != at("sync")) == late), f"{out}/in")
        stream = ingest.file_source(spark, f"{out}/in", messages.schema)
        ingest.upsert_stream(T.to_bronze(stream, F.col("timestamp")), A.to_silver, f"{out}/silver", f"{out}/checkpoint").awaitTermination()
    silver = ingest.first_arrivals(spark, f"{out}/silver", ["reading_id", "metric_name"], "sync_timestamp", "ingestion_timestamp")
    silver = quality.flag_late(silver, seconds=quality.VERY_LATE_SECONDS, name="is_very_late")
    count = lambda c: F.count(F.when(F.col(c), 1))
    return silver.groupBy(K.date_key("event_timestamp").alias("date_key")).agg(F.count("*").alias("n"), count("is_late_arriving").alias("n_late"), count("is_very_late").alias("n_very_late"))
