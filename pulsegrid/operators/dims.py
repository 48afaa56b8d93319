"""Gold dimensions. The lists are fixed values of the health model."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.keys import age_group, body_zone, date_key, device_model, person_key, surrogate_key
from pulsegrid.sources.tables import seed

METRICS = [
    ("heart_rate_bpm", "bpm", 45.0, 180.0, "smartwatch"),
    ("spo2_pct", "%", 90.0, 100.0, "smartwatch"),
    ("steps_since_last", "steps", 0.0, 10000.0, "smartwatch"),
    ("skin_temp_celsius", "°C", 30.0, 38.0, "smartwatch"),
    ("hrv_ms", "ms", 10.0, 120.0, "smartwatch"),
    ("heart_rate_bpm", "bpm", 45.0, 200.0, "chest_strap"),
    ("hrv_ms", "ms", 10.0, 120.0, "chest_strap"),
    ("respiration_rate", "breaths/min", 8.0, 30.0, "chest_strap"),
    ("heart_rate_bpm", "bpm", 40.0, 100.0, "sleep_ring"),
    ("spo2_pct", "%", 88.0, 100.0, "sleep_ring"),
    ("skin_temp_celsius", "°C", 31.0, 37.0, "sleep_ring"),
    ("sleep_stage", "stage", 0.0, 4.0, "sleep_ring"),
    ("blood_glucose_mgdl", "mg/dL", 40.0, 400.0, "glucose_monitor"),
]
CATEGORIES = [
    ("Endocrine", "E00-E89", "Chapter IV: Endocrine, nutritional and metabolic diseases"),
    ("Circulatory", "I00-I99", "Chapter IX: Diseases of the circulatory system"),
    ("Respiratory", "J00-J99", "Chapter X: Diseases of the respiratory system"),
    ("Mental", "F01-F99", "Chapter V: Mental, Behavioural and Neurodevelopmental disorders"),
    ("Musculoskeletal", "M00-M99", "Chapter XIII: Diseases of the musculoskeletal system and connective tissue"),
    ("Digestive", "K00-K95", "Chapter XI: Diseases of the digestive system"),
]
CONDITIONS = [
    ("E11.9", "Type 2 diabetes without complications", "Endocrine"),
    ("I10", "Essential hypertension", "Circulatory"),
    ("J45.20", "Mild intermittent asthma, uncomplicated", "Respiratory"),
    ("E78.5", "Hyperlipidemia, unspecified", "Endocrine"),
    ("F32.1", "Major depressive disorder, single episode, moderate", "Mental"),
    ("M54.5", "Low back pain", "Musculoskeletal"),
    ("K21.0", "GERD with esophagitis", "Digestive"),
]
DRUG_CLASSES = [("Biguanides", "Antidiabetics"), ("ACE Inhibitors", "Antihypertensives"), ("Bronchodilators", "Respiratory agents"), ("Statins", "Cardiovascular agents"), ("SSRIs", "Antidepressants"), ("PPIs", "Gastrointestinal agents")]
MEDICATIONS = [("metformin", "Metformin HCl", "Biguanides"), ("lisinopril", "Lisinopril", "ACE Inhibitors"), ("albuterol", "Albuterol Sulfate", "Bronchodilators"), ("atorvastatin", "Atorvastatin Calcium", "Statins"), ("sertraline", "Sertraline HCl", "SSRIs"), ("omeprazole", "Omeprazole", "PPIs")]
LAB_CONDITIONS = [("HbA1c", "E11.9"), ("LDL", "E78.5"), ("BP_systolic", "I10")]


#: US holidays as month, first and last day they can fall on, and day of the week (1 is Sunday; None: any).
HOLIDAYS = [(1, 1, 1, None), (5, 25, 31, 2), (7, 4, 4, None), (9, 1, 7, 2), (11, 22, 28, 5), (12, 25, 25, None)]
#: Conditions that last, and classes of drugs whose patients are tested regularly.
CHRONIC = ("E11.9", "I10", "J45.20", "E78.5", "K21.0")
MONITORED = ("Biguanides", "ACE Inhibitors", "Statins")


def dim_date(spark: SparkSession, start: str = "2024-01-01", days: int = 1096) -> DataFrame:
    """A row per day: calendar parts, weekend, flu and allergy season, six US holidays, medical fiscal quarter, epidemiological week."""
    df = spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))
    month, day, dow = F.month("date"), F.dayofmonth("date"), F.dayofweek("date")
    holiday = reduce(Column.__or__, [(month == m) & day.between(a, b) & (F.lit(True) if d is None else dow == d) for m, a, b, d in HOLIDAYS])
    return df.select(
        "date", date_key("date").alias("date_key"), F.year("date").alias("year"), month.alias("month"), day.alias("day"), F.quarter("date").alias("quarter"), dow.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"), F.date_format("date", "MMMM").alias("month_name"), F.weekofyear("date").alias("week_of_year"), dow.isin(1, 7).alias("is_weekend"),
        month.isin(10, 11, 12, 1, 2, 3).alias("is_flu_season"), month.isin(3, 4, 5, 6).alias("is_allergy_season"), holiday.alias("is_holiday"),
        (F.floor(F.pmod(month - 10, F.lit(12)) / 3) + 1).cast("int").alias("fiscal_quarter_medical"), F.weekofyear("date").alias("cdc_epi_week"),
    )


def with_daylight(days: DataFrame, latitude: float = 40.0, date: str = "date") -> DataFrame:
    """daylight_hours by the sun's declination at a latitude, to a hundredth; 0 and 24 beyond the polar circles."""
    declination = 0.409 * F.sin(2 * math.pi * F.dayofyear(date) / 365 - 1.39)
    x = -math.tan(math.radians(latitude)) * F.tan(declination)
    return days.withColumn("daylight_hours", F.round(24 / math.pi * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))) + 1e-9, 2))


def with_critical_bounds(metrics: DataFrame, share: float = 0.1) -> DataFrame:
    """critical_low and critical_high: beyond the normal bounds by a share of their distance."""
    more = (F.col("normal_high") - F.col("normal_low")) * share
    return metrics.withColumn("critical_low", F.col("normal_low") - more).withColumn("critical_high", F.col("normal_high") + more)


def with_chronic(conditions: DataFrame) -> DataFrame:
    return conditions.withColumn("is_chronic", F.col("condition_code").isin(*CHRONIC))


def with_monitoring(drug_classes: DataFrame) -> DataFrame:
    return drug_classes.withColumn("requires_monitoring", F.col("class_name").isin(*MONITORED))


def dim_time(spark: SparkSession) -> DataFrame:
    df = spark.range(1440).select(F.floor(F.col("id") / 60).cast("int").alias("hour"), (F.col("id") % 60).cast("int").alias("minute"))
    h = F.col("hour")
    period = F.when(h.between(5, 11), "morning").when(h.between(12, 16), "afternoon").when(h.between(17, 20), "evening").otherwise("night")
    return df.select((h * 100 + F.col("minute")).alias("time_key"), "hour", "minute", F.format_string("%02d:%02d", "hour", "minute").alias("time_str"), period.alias("period_of_day"), ((h >= 22) | (h < 7)).alias("is_sleep_window"), h.between(8, 16).alias("is_clinical_hours"))


def dim_condition_category(spark: SparkSession) -> DataFrame:
    df = seed(spark, CATEGORIES, "category_name string, category_code string, icd_chapter string")
    return df.select(surrogate_key("category_name").alias("condition_category_key"), "category_code", "category_name", "icd_chapter")


def dim_condition(spark: SparkSession) -> DataFrame:
    df = seed(spark, CONDITIONS, "condition_code string, condition_name string, category_name string").join(dim_condition_category(spark), "category_name", "left")
    return df.select(surrogate_key("condition_code").alias("condition_key"), "condition_code", "condition_name", "condition_category_key")


def dim_drug_class(spark: SparkSession) -> DataFrame:
    return seed(spark, DRUG_CLASSES, "class_name string, drug_family string").select(surrogate_key("class_name").alias("drug_class_key"), "class_name", "drug_family")


def dim_medication(spark: SparkSession) -> DataFrame:
    df = seed(spark, MEDICATIONS, "medication_name string, generic_name string, class_name string").join(dim_drug_class(spark), "class_name", "left")
    return df.select(surrogate_key("medication_name").alias("medication_key"), "medication_name", "generic_name", "drug_class_key")


def dim_metric(spark: SparkSession, rows: list[tuple] = METRICS) -> DataFrame:
    df = seed(spark, rows, "metric_name string, unit string, normal_low double, normal_high double, device_type string")
    return df.select(surrogate_key("metric_name", "device_type").alias("metric_key"), "metric_name", "unit", "normal_low", "normal_high", "device_type")


def primary_conditions(conditions: DataFrame, dim: DataFrame) -> DataFrame:
    """Each patient's active condition of the earliest onset; the lesser code on a tie."""
    df = conditions.filter("status = 'active'").join(dim.select("condition_key", F.col("condition_code").alias("icd10_code")), "icd10_code")
    return df.groupBy("patient_id").agg(F.min_by("condition_key", F.struct(F.coalesce("onset_date", F.lit("9999-12-31").cast("date")), "icd10_code")).alias("primary_condition_key"))


def dim_patient_of_ehr(demographics: DataFrame, as_of_year: int) -> DataFrame:
    """The patient dimension before there is an identity bridge: a person for each e-mail address of the clinical batches, the least record number of several; conditions and devices are unknown. Records without an address name no person."""
    people = demographics.filter("patient_email IS NOT NULL").withColumn("person", person_key("patient_email"))
    one = people.groupBy("person").agg(F.min(F.struct("patient_id", "patient_birth_year")).alias("x")).select("person", "x.*")
    return one.select(surrogate_key("person").alias("patient_key"), person_key("patient_id").alias("patient_id_masked"), age_group("patient_birth_year", as_of_year).alias("age_group"), F.lit("Unknown").alias("gender"), F.lit(None).cast("long").alias("primary_condition_key"), F.lit(0).cast("long").alias("device_count"), F.lit(None).cast("date").alias("first_reading_date"))


def dim_patient(bridge: DataFrame, demographics: DataFrame, conditions: DataFrame, condition_dim: DataFrame, readings: DataFrame, as_of_year: int) -> DataFrame:
    """A row per person with a record number: masked id, age group, primary condition, devices and first reading."""
    of = lambda kind: bridge.filter((F.col("identifier_type") == kind) & F.col("patient_key").isNotNull()).select(F.col("patient_key").alias("person"), F.col("identifier_value"))
    people = of("hospital_mrn").groupBy("person").agg(F.min("identifier_value").alias("patient_id"))
    people = people.join(of("email").select("person").distinct(), "person")
    ages = demographics.select("patient_id", age_group("patient_birth_year", as_of_year).alias("age_group"))
    devices = readings.join(of("device_account_id").withColumnRenamed("identifier_value", "device_account_id"), "device_account_id").groupBy("person").agg(F.countDistinct("device_id").alias("device_count"), F.min(F.to_date("event_timestamp")).alias("first_reading_date"))
    df = people.join(ages, "patient_id", "left").join(primary_conditions(conditions, condition_dim), "patient_id", "left").join(devices, "person", "left")
    return df.select(surrogate_key("person").alias("patient_key"), person_key("patient_id").alias("patient_id_masked"), F.coalesce("age_group", F.lit("Unknown")).alias("age_group"), F.lit("Unknown").alias("gender"), "primary_condition_key", F.coalesce("device_count", F.lit(0)).cast("long").alias("device_count"), "first_reading_date")


def dim_device(readings: DataFrame, bridge: DataFrame) -> DataFrame:
    """A row per device and firmware; the owner is the account's of the latest reading; registered at the first reading."""
    df = readings.groupBy("device_id", "firmware_version").agg(F.min("device_type").alias("device_type"), F.max_by("device_account_id", F.struct("event_timestamp", "device_account_id")).alias("device_account_id"), F.min(F.to_date("event_timestamp")).alias("registration_date"))
    owner = bridge.filter("identifier_type = 'device_account_id'").select(F.col("identifier_value").alias("device_account_id"), surrogate_key("patient_key").alias("patient_key"))
    return df.join(owner, "device_account_id", "left").select(surrogate_key("device_id", "firmware_version").alias("device_key"), "device_id", "device_type", device_model("device_id").alias("model"), "firmware_version", "patient_key", "registration_date", body_zone("device_type").alias("body_zone"))
