"""Dashboard queries over the gold tables. ``brand``, ``department`` and ``lab_test`` of ``None`` keep all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import all_present, map_labels, opt_filter
from perispark.operators.ordering import top_k


def drift_by_parameter(drift: DataFrame) -> DataFrame:
    return drift.groupBy("parameter_measured").agg(F.avg("drift_value").alias("mean_drift")).orderBy(F.desc("mean_drift"))


def share_of_total(df: DataFrame, part: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the percentage a row holds of its partition's total, in two decimals."""
    total = F.sum(value).over(Window.partitionBy(*part))
    return df.withColumn(name, F.round(F.try_divide(F.col(value), total) * 100, 2))


def failures_by_brand(failures: DataFrame, brand=None) -> DataFrame:
    """Failures per brand and reason with their share of the brand; the window sees one row per reason."""
    summed = opt_filter(failures, "equipment_brand", brand).groupBy("equipment_brand", "error_reason").agg(
        F.sum("failure_count").cast("double").alias("total_failures")
    )
    return share_of_total(summed, ["equipment_brand"], "total_failures", "failure_pct").orderBy(
        "equipment_brand", F.desc("failure_pct"), "error_reason"
    )


def grade_distribution(health: DataFrame, brand=None) -> DataFrame:
    return (
        opt_filter(health, "equipment_brand", brand)
        .groupBy(F.trim("health_grade").alias("health_grade"))
        .agg(F.count("sensor_name").alias("sensors"))
        .orderBy("health_grade")
    )


def noisiest_sensors(health: DataFrame, brand=None, k: int = 10) -> DataFrame:
    """Top ``k`` degraded or critical sensors by anomalies and failures; case and name settle ties."""
    rows = opt_filter(health, "equipment_brand", brand).where(F.col("health_grade").isin(fv.GRADE_DEGRADED, fv.GRADE_CRITICAL))
    noise = F.col("frozen_signal_count") + F.col("noise_spikes_count") + F.col("hardware_failures")
    top = top_k(rows, [noise.desc(), F.col("case_id"), F.col("sensor_name")], k)
    return top.select("case_id", "sensor_name", "frozen_signal_count", "noise_spikes_count", "hardware_failures")


def intervention_list(health: DataFrame, brand=None) -> DataFrame:
    return (
        opt_filter(health, "equipment_brand", brand)
        .orderBy(F.desc("health_grade"), F.desc("null_rate_percentage"), "case_id", "sensor_name")
        .select("health_grade", "case_id", "sensor_name", "equipment_brand", F.round("null_rate_percentage", 1).alias("null_pct"))
    )


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def label_departments(impact: DataFrame) -> DataFrame:
    return impact.withColumn("department", map_labels("department", fv.DEPARTMENT_LABELS))


def filter_impact(impact: DataFrame, department=None, lab_test=None) -> DataFrame:
    return opt_filter(opt_filter(impact, "department", department), "lab_test", lab_test)


def impact_kpis(impact: DataFrame) -> DataFrame:
    """Patients, mean age, mean ICU stay and tests; means weigh rows, not patients, and are 0 for no rows."""
    return impact.agg(
        F.count_distinct("caseid").alias("patients"),
        F.coalesce(F.round(F.avg("age"), 1), F.lit(0.0)).alias("mean_age"),
        F.coalesce(F.round(F.avg("icu_days"), 1), F.lit(0.0)).alias("mean_icu_days"),
        F.count_distinct("lab_test").alias("lab_tests"),
    )


def impact_by_test(impact: DataFrame) -> DataFrame:
    """Mean change per test, from loss to gain, with its code and full name."""
    means = impact.where(F.col("lab_test").isNotNull()).groupBy("lab_test").agg(F.avg("absolute_delta").alias("mean_delta"))
    return means.select(
        "lab_test", F.upper("lab_test").alias("code"), map_labels("lab_test", fv.LAB_LABELS, "upper").alias("label"), "mean_delta"
    ).orderBy("mean_delta", "lab_test")


def impact_by_sex(impact: DataFrame, dim: str = "lab_test") -> DataFrame:
    """Mean change per test (or department) and sex."""
    return impact.where(all_present([dim, "sex"])).groupBy(dim, "sex").agg(F.avg("absolute_delta").alias("mean_delta"))


def impact_by_department(impact: DataFrame) -> DataFrame:
    return (
        impact.where(F.col("department").isNotNull())
        .groupBy("department")
        .agg(F.avg("pre_op_avg").alias("mean_pre"), F.avg("pos_op_avg").alias("mean_post"))
        .orderBy("mean_pre", "department")
    )
