"""The stored tables from raw feed to gold, each gated by its contract.

Steps run in layer order and stop at the first broken contract. Derived tables are replaced, not appended to,
so a rerun gives the same state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from perispark import fixed_values as fv
from perispark.contracts import CONTRACTS
from perispark.operators import sensors as s
from perispark.operators.quality import quality_gate
from perispark.operators.reshape import to_long_clean
from perispark.plans.icu import icu_features
from perispark.plans.labs import labs_split, pre_vs_post
from perispark.plans.patients import patients_split
from perispark.plans.vitals import vitals_clean_quarantine
from perispark.sources.csv import read_csv_feed, with_audit
from perispark.sources.dims import lab_limits, sensors_metadata
from perispark.sources.lake import Lake, cluster_for_cases

POSITION = ["_file", "_row"]  # the order in which a bronze table was stored


def store(lake: Lake, df: DataFrame, layer: str, table: str, mode: str = "overwrite", **options) -> bool:
    return lake.write(df, layer, table, mode, CONTRACTS.get(f"{layer}.{table}"), **options)


# ---- bronze ----
def ingest_vitals(lake: Lake, path: str, schema=None, ts: dt.datetime | None = None) -> bool:
    return store(lake, with_audit(read_csv_feed(lake.spark, path, schema), fv.SOURCE_VITALS, ts), "bronze", "vitals", "append")


def ingest_labs(lake: Lake, path: str, schema=None, ts: dt.datetime | None = None) -> bool:
    return store(lake, with_audit(read_csv_feed(lake.spark, path, schema), fv.SOURCE_LABS, ts), "bronze", "labs", "append")


def ingest_patients(lake: Lake, path: str, schema=None, ts: dt.datetime | None = None, order: Sequence[str] | None = None) -> bool:
    """Upsert on (caseid, subjectid); an identical feed changes nothing."""
    df = with_audit(read_csv_feed(lake.spark, path, schema), fv.SOURCE_PATIENTS, ts)
    quality_gate(df, CONTRACTS["bronze.patients"])
    return lake.upsert(df, "bronze", "patients", order=order)


# ---- silver ----
def build_vitals(lake: Lake, layout_buckets: int | None = None) -> None:
    """``layout_buckets`` lays the clean table out by case and day for readers of single cases, at one shuffle."""
    clean, quarantine = vitals_clean_quarantine(lake.read("bronze", "vitals"))
    if layout_buckets:
        clean = cluster_for_cases(clean, layout_buckets)
    store(lake, clean, "silver", "vitals_clean")
    store(lake, quarantine, "silver", "vitals_quarantine")


def build_labs(lake: Lake) -> None:
    results, quarantine = labs_split(lake.read("bronze", "labs", position=True), tie=POSITION)
    store(lake, results.drop(*POSITION), "silver", "labs_results_classified")
    store(lake, quarantine.drop(*POSITION), "silver", "labs_quarantine")


def build_patients(lake: Lake) -> None:
    bronze = lake.read("bronze", "patients", position=True)
    demographics, surgery, quarantine = patients_split(bronze, order=["ingest_time", *POSITION])
    store(lake, demographics, "silver", "patients_demographics")
    store(lake, surgery, "silver", "patients_surgery_context")
    store(lake, quarantine.drop(*POSITION), "silver", "patients_quarantine")


def build_dimensions(lake: Lake) -> None:
    store(lake, sensors_metadata(lake.spark), "silver", "sensors_metadata")
    store(lake, lab_limits(lake.spark), "silver", "labs_metadata_limits")


def build_silver(lake: Lake) -> None:
    build_dimensions(lake)
    build_vitals(lake)
    build_labs(lake)
    build_patients(lake)


# ---- gold ----
def _optional(lake: Lake, layer: str, table: str, schema: str) -> DataFrame:
    """A table that is not stored while it has no rows."""
    return lake.read(layer, table) if lake.exists(layer, table) else lake.spark.createDataFrame([], schema)


def build_sensor_products(lake: Lake, gap_seconds: float = 60, window_minutes: int = 5, low: float | None = None,
                          high: float | None = None, sample_seconds: float = 1) -> None:
    clean = lake.read("silver", "vitals_clean")
    dim = lake.read("silver", "sensors_metadata")
    quarantine = _optional(lake, "silver", "vitals_quarantine",
                           "case_id long, time timestamp_ntz, sensor_name string, original_value double, error_reason string")
    store(lake, s.cross_sensor_drift(clean), "gold", "cross_sensor_drift")
    store(lake, s.hardware_failures(quarantine, dim), "gold", "hardware_failures_summary")
    store(lake, s.sensor_health(clean, quarantine, dim, sample_seconds=sample_seconds), "gold", "sensor_health_summary")
    long = to_long_clean(clean)
    # these two are stored as they are: a case of one instant has no rate
    lake.write(s.sensor_uptime(long, gap_seconds), "gold", "sensor_uptime_rates")
    lake.write(s.view_window(long, window_minutes, low, high), "gold", "view_window")


def build_clinical_products(lake: Lake) -> None:
    labs = lake.read("silver", "labs_results_classified")
    demographics = lake.read("silver", "patients_demographics")
    surgery = lake.read("silver", "patients_surgery_context")
    store(lake, pre_vs_post(labs, demographics, surgery), "gold", "pre_vs_post_operation")
    store(lake, icu_features(demographics, surgery, labs), "gold", "icu_ml_features")


def build_gold(lake: Lake, **sensor_options) -> None:
    build_sensor_products(lake, **sensor_options)
    build_clinical_products(lake)
