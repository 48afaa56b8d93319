"""Readers and sinks: the bronze envelope, clinical batches, tables, JDBC export, freshness, replay and compaction."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ENTRY = "resource_type string, code string, description string, category string, is_chronic boolean, onset_date string, status string, clinician_npi string, medication string, generic_name string, drug_class string, dosage string, frequency string, start_date string, end_date string, prescriber_npi string, value double, unit string, reference_low double, reference_high double, is_abnormal boolean, date string"
EHR_SCHEMA = f"batch_date string, patient_count int, patients array<struct<resource_type:string,patient_id:string,patient_name:string,patient_email:string,patient_birth_year:int,patient_zip:string,generated_at:string,entries:array<struct<{', '.join(x.replace(' ', ':', 1) for x in ENTRY.split(', '))}>>>>"
BRONZE_COLUMNS = ["raw_value", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingestion_timestamp", "ingestion_date", "ingestion_hour"]


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir; where that is unset, a temporary one for a local master, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # a master that can't be read may be a cluster's; local-cluster has executors of its own
        if not re.match(r"local($|\[)", spark.conf.get("spark.master", None) or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="pulsegrid-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/pulsegrid/{uuid.uuid4().hex}"


def to_bronze(df: DataFrame, ingested: Column | None = None) -> DataFrame:
    """The bronze envelope of rows with value, topic, partition, offset and timestamp, as a broker gives them; works on streams."""
    at = F.current_timestamp() if ingested is None else ingested
    out = df.select(F.col("value").cast("string").alias("raw_value"), F.col("topic").cast("string").alias("kafka_topic"), F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").cast("long").alias("kafka_offset"), F.col("timestamp").cast("timestamp").alias("kafka_timestamp"), at.alias("ingestion_timestamp"))
    return out.withColumn("ingestion_date", F.date_format("ingestion_timestamp", "yyyy-MM-dd")).withColumn("ingestion_hour", F.date_format("ingestion_timestamp", "HH"))


def read_ehr(spark: SparkSession, glob: str, multi_line: bool = True) -> DataFrame:
    """A row per patient of every <date>/ehr_batch.json that the pattern names, a batch in a file or, without multi_line, in each line; batch_date comes from the path, else from the file."""
    raw = spark.read.schema(EHR_SCHEMA).option("multiLine", multi_line).json(glob).withColumn("of_path", F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2}-\d{2})", 1))
    return raw.select(F.coalesce(F.nullif(F.col("of_path"), F.lit("")), F.col("batch_date")).alias("batch_date"), F.explode("patients").alias("p")).select("batch_date", "p.*")


def demographics(patients: DataFrame) -> DataFrame:
    """One row per patient_id: the one of the latest batch."""
    return patients.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.max(F.struct("batch_date", "patient_email", "patient_birth_year")).alias("x")).select("patient_id", "x.patient_email", "x.patient_birth_year")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at the path, None where there is none."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def parse_topic(bronze: DataFrame, topic: str, schema: str) -> DataFrame:
    """The messages of one topic, JSON objects of the schema, with their ingestion time; malformed ones give nulls."""
    return bronze.filter(F.col("kafka_topic") == topic).select(F.from_json("raw_value", schema).alias("m"), "ingestion_timestamp").select("m.*", "ingestion_timestamp")


#: The messages of the activity and registry topics.
ACTIVITY = "session_id string, device_account_id string, activity string, source string, start timestamp, minutes double"
REGISTRY = "device_account_id string, device_id string, email string, registered timestamp"


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


#: A comma outside of quotes.
COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files with a header line that fit the schema, and the lines that don't: (file, line, reason).

    The reason is `few` or `many` for a line with fewer or more fields than the schema, else `type` and the names of the fields
    whose text isn't of their type. Empty fields are nulls and fit every type. No line is lost.
    """
    whole = StructType([*schema.fields, StructField("_line", StringType())])
    raw = spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path).withColumn("_file", F.col("_metadata.file_name"))
    fields = F.split(F.col("_line"), COMMA, -1)
    wrong = [F.when((F.get(fields, F.lit(k)) != "") & F.col(f.name).isNull(), F.lit(f.name)) for k, f in enumerate(schema.fields)]
    size = F.size(fields)
    reason = F.when(size < len(wrong), "few").when(size > len(wrong), "many").otherwise(F.concat(F.lit("type "), F.array_join(F.array_compact(F.array(*wrong)), ", ")))
    good = raw.filter("_line IS NULL").drop("_line", "_file")
    return good, raw.filter("_line IS NOT NULL").select(F.col("_file").alias("file"), F.col("_line").alias("line"), reason.alias("reason"))


#: The columns of feedback files.
FEEDBACK = "feedback_id long, device_account_id string, rating int, comment string, submitted timestamp"


def overwrite(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def or_empty(df: DataFrame | None, spark: SparkSession, schema: StructType | str) -> DataFrame:
    """df, or the empty typed table where the upstream is missing."""
    return spark.createDataFrame([], schema) if df is None else df


def seed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few literal rows as part of the plan, so that the optimizer knows their size."""
    fields = [x.strip().split(" ", 1) for x in schema.split(",")]
    each = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(each))


def export_jdbc(tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None, only: Iterable[str] | None = None, partitions: dict[str, tuple[int, str]] | None = None) -> dict[str, str]:
    """Truncates and writes each table, dimensions before facts. A table that fails doesn't stop the others: the result has "ok" or the error by table."""
    wanted = set(tables if only is None else only)
    result = {}
    for name in sorted(wanted & tables.keys(), key=lambda t: (t.startswith("fact_"), t)):
        df = tables[name]
        if partitions and name in partitions:
            n, column = partitions[name]
            df = df.repartition(n, column)
        try:
            df.write.mode("overwrite").option("truncate", True).jdbc(url, name, properties=properties or {})
            result[name] = "ok"
        except Exception as e:  # noqa: BLE001 - reported by table
            result[name] = f"failed: {str(e).splitlines()[0]}"
    return result


def import_jdbc(spark: SparkSession, url: str, table: str, column: str, partitions: int, properties: dict[str, str] | None = None) -> DataFrame:
    """The table, read by so many tasks, each a range of the whole-number column between its bounds, which the database is asked for. Nulls come with the first range."""
    props = properties or {}
    ask = f"(SELECT min(\"{column}\") AS low, max(\"{column}\") AS high FROM {table}) bounds"
    bounds = spark.read.jdbc(url, ask, properties=props).first()
    low, high = (None, None) if bounds is None else (bounds[0], bounds[1])
    if low is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column, int(low), int(high) + 1, partitions, properties=props)


def freshness(tables: dict[str, tuple[DataFrame, str]], sla_hours: dict[str, int], now: Column) -> DataFrame:
    """(table, hours, sla_hours, status) by the latest value of each table's time column; an empty table is stale."""
    parts = []
    for name, (df, column) in tables.items():
        age = (F.unix_timestamp(now) - F.unix_timestamp(F.max(column))) / 3600
        parts.append(df.agg(age.alias("hours")).select(F.lit(name).alias("table"), "hours", F.lit(sla_hours[name]).alias("sla_hours")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("hours") <= F.col("sla_hours"), "ok").otherwise("stale"))


def replay(spark: SparkSession, bronze: str, since: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The transform over bronze partitions from the date on; only these are read."""
    return transform(spark.read.parquet(bronze).filter(F.col("ingestion_date") >= since))


def compact(df: DataFrame, files: int, keys: list[str]) -> DataFrame:
    """df, clustered: few files, each of a range of the keys and sorted, so that later scans skip by statistics."""
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
