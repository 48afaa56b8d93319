"""Serving views over the gold tables, as SQL. Means are rounded after adding 1e-9, so that a tie goes up whatever its last bit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: `{t}` stands for the table's view name.
VIEWS = {
    "patient_vital_trends": """
        SELECT f.patient_key, p.age_group, p.gender, m.metric_name, m.unit, m.normal_low, m.normal_high, f.date_key,
               to_date(CAST(f.date_key AS string), 'yyyyMMdd') AS reading_date,
               f.avg_value, f.min_value, f.max_value, f.reading_count, f.anomaly_count, f.pct_in_normal_range,
               CASE WHEN f.avg_value < m.normal_low THEN 'below_normal' WHEN f.avg_value > m.normal_high THEN 'above_normal' ELSE 'normal' END AS avg_status
        FROM {fact_vital_daily_summary} f JOIN {dim_metric} m ON f.metric_key = m.metric_key JOIN {dim_patient} p ON f.patient_key = p.patient_key""",
    "active_anomaly_alerts": """
        SELECT a.alert_key, a.patient_key, p.age_group, p.gender, m.metric_name, m.unit, a.date_key,
               to_date(CAST(a.date_key AS string), 'yyyyMMdd') AS alert_date, a.time_key, a.alert_type, a.severity,
               a.metric_value, a.threshold_value, a.patient_baseline,
               round((a.metric_value - a.patient_baseline) / nullif(a.patient_baseline, 0) * 100 + 1e-9, 1) AS pct_deviation, a.resolved_flag, a.resolved_timestamp
        FROM {fact_anomaly_alert} a JOIN {dim_metric} m ON a.metric_key = m.metric_key JOIN {dim_patient} p ON a.patient_key = p.patient_key
        WHERE NOT a.resolved_flag""",
    "medication_timeline": """
        SELECT f.fill_key, f.patient_key, p.age_group, p.gender, m.medication_name, m.generic_name, c.class_name, c.drug_family, f.date_key,
               to_date(CAST(f.date_key AS string), 'yyyyMMdd') AS fill_date, f.days_supply, f.refill_number, f.status,
               CASE WHEN f.refill_number = 0 THEN 'new_prescription' ELSE 'refill' END AS fill_type
        FROM {fact_prescription_fill} f JOIN {dim_medication} m ON f.medication_key = m.medication_key
        JOIN {dim_drug_class} c ON m.drug_class_key = c.drug_class_key JOIN {dim_patient} p ON f.patient_key = p.patient_key""",
    "lab_results_by_condition": """
        SELECT l.patient_key, p.age_group, p.gender, l.date_key, to_date(CAST(l.date_key AS string), 'yyyyMMdd') AS result_date,
               l.lab_test_name, l.result_value, l.result_unit, l.reference_range_low, l.reference_range_high, l.is_abnormal,
               c.condition_name, g.category_name AS condition_category,
               CASE WHEN l.result_value < l.reference_range_low THEN 'low' WHEN l.result_value > l.reference_range_high THEN 'high' ELSE 'normal' END AS result_status
        FROM {fact_lab_result} l LEFT JOIN {dim_condition} c ON l.condition_key = c.condition_key
        LEFT JOIN {dim_condition_category} g ON c.condition_category_key = g.condition_category_key JOIN {dim_patient} p ON l.patient_key = p.patient_key""",
    "population_analytics": """
        SELECT p.age_group, p.gender, m.metric_name, m.unit, m.normal_low, m.normal_high, f.date_key,
               to_date(CAST(f.date_key AS string), 'yyyyMMdd') AS reading_date, count(DISTINCT f.patient_key) AS patient_count,
               round(avg(f.avg_value) + 1e-9, 2) AS cohort_avg, round(min(f.min_value), 2) AS cohort_min, round(max(f.max_value), 2) AS cohort_max,
               sum(f.reading_count) AS total_readings, sum(f.anomaly_count) AS total_anomalies, round(avg(f.pct_in_normal_range) + 1e-9, 1) AS avg_pct_in_normal_range
        FROM {fact_vital_daily_summary} f JOIN {dim_metric} m ON f.metric_key = m.metric_key JOIN {dim_patient} p ON f.patient_key = p.patient_key
        GROUP BY p.age_group, p.gender, m.metric_name, m.unit, m.normal_low, m.normal_high, f.date_key""",
}


def view(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The named view over the given gold tables."""
    used = {t: df for t, df in tables.items() if "{" + t + "}" in VIEWS[name]}
    return spark.sql(VIEWS[name], **used)
