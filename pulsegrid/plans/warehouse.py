"""Bronze to gold in the order of the stages, from the adapter's sources or given ones."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.operators import dims, facts
from pulsegrid.sources import adapter
from pulsegrid.sources.tables import overwrite, shared_folder

AS_OF_YEAR = 2024


class Warehouse:
    """The gold tables as lazy DataFrames; each is built from the sources it needs, once.

    With `stored`, silver is written to the shared folder first, for results that use it more than once: bronze is parsed
    once, and each use reads only its columns.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = False) -> None:
        self.spark, self.sf_dir, self.stored = spark, sf_dir, stored

    @cached_property
    def readings(self) -> DataFrame:
        df = adapter.readings(self.spark, self.sf_dir)
        if not self.stored:
            return df
        path = shared_folder(self.spark)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def bridge(self) -> DataFrame:
        return adapter.bridge(self.spark, self.sf_dir)

    @cached_property
    def dim_metric(self) -> DataFrame:
        return dims.dim_metric(self.spark, adapter.METRICS)

    @cached_property
    def dim_condition(self) -> DataFrame:
        return dims.dim_condition(self.spark)

    @cached_property
    def dim_condition_category(self) -> DataFrame:
        return dims.dim_condition_category(self.spark)

    @cached_property
    def dim_medication(self) -> DataFrame:
        return dims.dim_medication(self.spark)

    @cached_property
    def dim_drug_class(self) -> DataFrame:
        return dims.dim_drug_class(self.spark)

    @cached_property
    def dim_patient(self) -> DataFrame:
        return dims.dim_patient(self.bridge, adapter.demographics(self.spark, self.sf_dir), adapter.conditions(self.spark, self.sf_dir), self.dim_condition, self.readings, AS_OF_YEAR)

    @cached_property
    def dim_device(self) -> DataFrame:
        return dims.dim_device(self.readings, self.bridge)

    @cached_property
    def fact_anomaly_alert(self) -> DataFrame:
        return facts.fact_anomaly_alert(self.readings, self.bridge, self.dim_metric)

    @cached_property
    def fact_vital_reading(self) -> DataFrame:
        return facts.fact_vital_reading(self.readings, self.bridge, self.dim_metric, self.dim_device)

    @cached_property
    def fact_vital_daily_summary(self) -> DataFrame:
        return facts.fact_vital_daily_summary(self.readings, self.bridge, self.dim_metric)

    @cached_property
    def fact_lab_result(self) -> DataFrame:
        return facts.fact_lab_result(adapter.labs(self.spark, self.sf_dir), self.bridge, self.dim_condition)

    @cached_property
    def fact_prescription_fill(self) -> DataFrame:
        return facts.fact_prescription_fill(adapter.fills(self.spark, self.sf_dir), self.dim_medication)

    GOLD = ("dim_condition_category", "dim_drug_class", "dim_metric", "dim_patient", "dim_condition", "dim_medication", "dim_device", "fact_vital_reading", "fact_vital_daily_summary", "fact_lab_result", "fact_prescription_fill", "fact_anomaly_alert")

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in names or self.GOLD}


def run_pipeline(spark: SparkSession, sf_dir: str, out: str) -> dict[str, DataFrame]:
    """Writes silver and gold below `out`, each stage from its predecessor's files, and returns the tables as written."""
    w = Warehouse(spark, sf_dir)

    def written(name: str, df: DataFrame, layer: str) -> DataFrame:
        overwrite(df, f"{out}/{layer}/{name}")
        return spark.read.parquet(f"{out}/{layer}/{name}")

    w.readings = written("sensor_readings", w.readings, "silver")
    w.bridge = written("patient_identity_bridge", w.bridge, "silver")
    for name in w.GOLD:
        w.__dict__[name] = written(name, getattr(w, name), "gold")
    return w.tables()
