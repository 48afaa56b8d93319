"""The star-schema and event tables as the sources of the health model. Every mapping is plain arithmetic on the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.keys import mapped
from pulsegrid.operators.identity import bridge_rows, ehr_pairs, link_devices, pending_devices
from pulsegrid.operators.parse import explode_metrics, parse_readings
from pulsegrid.operators.quality import flag_late, flag_valid
from pulsegrid.operators.windows import keep_first

DEVICE_OF = {"view": "smartwatch", "click": "chest_strap", "signup": "sleep_ring", "purchase": "glucose_monitor", "error": "smartwatch"}
PREFIX_OF = {"smartwatch": "SW", "chest_strap": "CS", "sleep_ring": "SR", "glucose_monitor": "GM"}
BOUNDS = {event: (0, 150) for event in DEVICE_OF}
METRICS = [(event, "units", 5.0, 100.0, device) for event, device in DEVICE_OF.items()]
CODES = ["E11.9", "I10", "J45.20", "E78.5", "F32.1", "M54.5", "K21.0"]
DRUGS = ["Metformin", "Lisinopril", "Albuterol", "Atorvastatin", "Sertraline", "Omeprazole", "Ibuprofen"]
SEEN = "2024-02-01"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(events: DataFrame) -> DataFrame:
    """Sensor messages as a broker gives them: 30 % late, some by more than two days, some values null or no number, 2 % sent twice; works on streams."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    device = mapped(F.col("event_type"), DEVICE_OF, "smartwatch")
    late = F.when(F.col("event_id") % 211 == 0, 200000).when(F.col("event_id") % 10 < 3, F.col("event_id") * 37 % 28800).otherwise(0)
    e = e.withColumn("again", F.explode(F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(3600))).otherwise(F.array(F.lit(0)))))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    value = F.when(F.col("event_id") % 100 == 0, F.lit(None)).when(F.col("event_id") % 97 == 0, F.lit("deep")).otherwise(F.col("value").cast("string"))
    micros = F.timestamp_micros(F.unix_micros("ts") + ((late + F.col("again")) * 1000000).cast("long"))
    message = F.struct(
        F.col("event_id").cast("string").alias("reading_id"), F.concat(mapped(device, PREFIX_OF, "XX"), F.lit("-"), F.col("user_id").cast("string")).alias("device_id"), device.alias("device_type"),
        F.concat(F.lit("acct_"), F.col("user_id").cast("string")).alias("user_device_account_id"), F.create_map(F.col("event_type"), value).alias("metrics"),
        F.concat(F.lit("v"), (F.get_json_object("props", "$.k").cast("long") % 4).cast("string")).alias("firmware_version"), (F.col("event_id") % 101).alias("battery_pct"),
        iso(F.col("ts")).alias("event_timestamp"), iso(micros).alias("sync_timestamp"),
    )
    return e.select(F.to_json(message, {"ignoreNullFields": "false"}).alias("value"), F.lit("sensor_readings").alias("topic"), (F.col("user_id") % 6).cast("int").alias("partition"), (F.col("event_id") * 2 + (F.col("again") > 0).cast("int")).alias("offset"), micros.alias("timestamp"))


def bronze(events: DataFrame) -> DataFrame:
    from .tables import to_bronze

    return to_bronze(event_messages(events), F.col("timestamp"))


def to_silver(bronze_df: DataFrame, dedup: bool = True) -> DataFrame:
    """Parsed, exploded, flagged and deduplicated readings."""
    df = flag_late(flag_valid(explode_metrics(parse_readings(bronze_df)), BOUNDS))
    return keep_first(df, ["reading_id", "metric_name"], "sync_timestamp", "ingestion_timestamp") if dedup else df


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze(load(spark, sf_dir, "events")))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four of five device accounts are registered with an e-mail address."""
    users = load(spark, sf_dir, "events").select("user_id").distinct().filter("user_id % 5 <> 0")
    return users.select(F.concat(F.lit("acct_"), F.col("user_id")).alias("device_account_id"), F.concat(F.lit(" U"), F.col("user_id"), F.lit("@Example.com")).alias("email"))


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From orders: a patient's conditions by batch date."""
    o = load(spark, sf_dir, "orders")
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), ((F.col("o_custkey") * 3 + F.col("o_orderkey")) % 7 + 1).cast("int"))
    return o.select(F.concat(F.lit("MRN"), F.col("o_custkey")).alias("patient_id"), F.concat(F.lit("U"), F.col("o_custkey"), F.lit("@example.com ")).alias("patient_email"), code.alias("icd10_code"), F.when(F.col("o_orderstatus") == "F", "resolved").otherwise("active").alias("status"), F.col("o_orderdate").cast("date").alias("onset_date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("batch_date"), F.col("o_orderkey").alias("seq"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From orders: (patient, batch date, status, dosage), several in a day possible."""
    from pulsegrid.functions.keys import row_hash

    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("patient"), F.col("o_orderdate").cast("date").alias("batch_date"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("dosage"), F.col("o_orderkey").alias("seq")).withColumn("row_hash", row_hash("status", "dosage"))


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    test = mapped(F.col("l_returnflag"), {"A": "HbA1c", "N": "LDL"}, "TSH")
    df = li.select(F.concat(F.lit("MRN"), F.col("l_suppkey")).alias("patient_id"), test.alias("test_code"), F.col("l_quantity").alias("value"), F.lit("u").alias("unit"), F.lit(10.0).alias("reference_low"), F.lit(40.0).alias("reference_high"), (~F.col("l_quantity").between(10, 40)).alias("is_abnormal"), F.col("l_shipdate").cast("date").alias("test_date"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("batch_date"))
    return df.withColumn("observation_id", F.sha2(F.concat_ws("|", "patient_id", "test_code", F.col("test_date").cast("string"), F.col("value").cast("string")), 256))


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    drug = F.element_at(F.array(*[F.lit(d) for d in DRUGS]), (F.col("l_partkey") % 7 + 1).cast("int"))
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("rx_id"), F.concat(F.lit("PH"), F.col("l_suppkey")).alias("pharmacy_patient_id"), F.when(F.col("l_partkey") % 2 == 0, "68180-0512").otherwise("99999-1").alias("ndc_code"), F.concat(drug, F.lit(" 500mg")).alias("drug_name"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("fill_date"), F.lit(30).alias("days_supply"), (F.col("l_linenumber") - 1).alias("refill_number"), F.when(F.col("l_linestatus") == "O", "active").otherwise("complete").alias("status"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From orders: change events of prescriptions; every even one is updated a day later, every tenth deleted."""
    o = load(spark, sf_dir, "orders").withColumn("ms", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000)
    base = o.select(F.col("o_orderkey").cast("string").alias("rx_id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("patient"), "ms", F.col("o_orderkey").alias("k"))
    create = base.select("rx_id", F.lit("c").alias("op"), "status", "patient", F.col("ms").alias("ts_ms"), (F.col("k") * 3).alias("offset"))
    update = base.filter("k % 2 = 0").select("rx_id", F.lit("u").alias("op"), F.lit("X").alias("status"), "patient", (F.col("ms") + 86400000).alias("ts_ms"), (F.col("k") * 3 + 1).alias("offset"))
    delete = base.filter("k % 10 = 0").select("rx_id", F.lit("d").alias("op"), "status", "patient", (F.col("ms") + 86400000).alias("ts_ms"), (F.col("k") * 3 + 2).alias("offset"))
    return create.unionByName(update).unionByName(delete)


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.filter("c_custkey % 11 <> 0").select(F.concat(F.lit("MRN"), F.col("c_custkey")).alias("patient_id"), F.concat(F.lit("u"), F.col("c_custkey"), F.lit("@example.com")).alias("patient_email"), (F.lit(1935) + F.col("c_custkey") % 85).cast("int").alias("patient_birth_year"))


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    conds = conditions(spark, sf_dir)
    seen = F.lit(SEEN).cast("timestamp")
    events = load(spark, sf_dir, "events").select(F.concat(F.lit("acct_"), F.col("user_id")).alias("device_account_id"))
    devices = link_devices(pending_devices(events, seen), registry(spark, sf_dir))
    return bridge_rows(ehr_pairs(conds, conds), seen).unionByName(devices)
