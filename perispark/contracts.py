"""Contracts of our own tables."""

from __future__ import annotations

from collections.abc import Sequence

from perispark.operators.quality import Contract, Objective, Rule


def _contract(name: str, required: str, *rules: tuple[str, str] | str, fields: Sequence[tuple[str, str, bool]] = (), **slo: str) -> Contract:
    """``fields`` are (name, type, nullable); ``slo`` are objectives by name."""
    more = tuple(Rule(*r) if isinstance(r, tuple) else Rule(r) for r in rules)
    return Contract(name, (Rule(f"no_nulls({required})"), *more), tuple(fields), tuple(Objective(k, v) for k, v in slo.items()))


# --- fixed values: objectives per table ---
AFTER_EVENT, AFTER_BRONZE = "P95 <= 10m after event generation", "P95 <= 15m after Bronze ingestion"
MOST_ROWS, ALL_INVALID, MOST_PASS = ">= 99% of valid rows", "100% of invalid rows", ">= 98% of events"
ON_DEMAND, ALL_TESTS = "Static reference table, updated on demand", "100% coverage of all lab tests"


_RAW = ("schema_allows_additional_columns", "info")

# --- fixed values: required columns and value rules per table ---
CONTRACTS = {c.id: c for c in [
    _contract("bronze.vitals", "ingest_time, source_system", _RAW,
              fields=[
                  ("case_id", "string", True), ("time", "timestamp", True), ("ingest_time", "timestamp", False),
                  ("source_system", "string", False),
              ]),
    _contract("bronze.labs", "ingest_time, source_system", _RAW,
              fields=[
                  ("caseid", "string", True), ("dt", "string", True), ("name", "string", True), ("result", "string", True),
                  ("ingest_time", "timestamp", False), ("source_system", "string", False),
              ]),
    _contract("bronze.patients", "ingest_time, source_system", _RAW,
              fields=[
                  ("caseid", "string", True), ("age", "string", True), ("sex", "string", True),
                  ("ingest_time", "timestamp", False), ("source_system", "string", False),
              ]),
    _contract("silver.vitals_clean", "case_id, time",
              "time <= current_timestamp()",
              ("case_id IN (SELECT DISTINCT case_id FROM bronze.vitals)", "warning"),
              fields=[
                  ("case_id", "string", False), ("time", "timestamp", False),
              ],
              freshness=AFTER_EVENT, completeness=MOST_ROWS, accuracy=MOST_PASS),
    _contract("silver.vitals_quarantine", "case_id, time, sensor_name, error_reason", "time <= current_timestamp()",
              fields=[
                  ("case_id", "string", False), ("time", "timestamp", True), ("sensor_name", "string", True),
                  ("original_value", "float", True), ("error_reason", "string", False),
              ]),
    _contract("silver.sensor_view_input", "case_id, time, ingest_time, sensor_id, is_valid", "time <= current_timestamp()",
              "is_valid IN (true, false)",
              fields=[
                  ("case_id", "string", False), ("time", "timestamp", False), ("ingest_time", "timestamp", False),
                  ("sensor_id", "string", False), ("is_valid", "boolean", False),
              ],
              freshness=AFTER_EVENT, completeness=MOST_ROWS, accuracy=MOST_PASS),
    _contract("silver.sensors_metadata", "sensor_id, parameter_measured",
              "uniqueness(sensor_id) == 100%",
              fields=[
                  ("sensor_id", "string", False), ("parameter_measured", "string", False), ("equipment_brand", "string", False),
                  ("unit_of_measure", "string", False),
              ]),
    _contract("silver.labs_results_classified", "caseid, name, result, surgery_phase", "result >= 0",
              fields=[
                  ("caseid", "string", False), ("name", "string", False), ("result", "float", False),
                  ("surgery_phase", "string", False), ("is_most_recent", "boolean", False),
              ],
              freshness=AFTER_BRONZE, completeness=MOST_ROWS),
    _contract("silver.labs_quarantine", "error_reason",
              fields=[
                  ("caseid", "string", True), ("name", "string", True), ("result", "float", True), ("dt", "float", True),
                  ("error_reason", "string", False),
              ],
              freshness=AFTER_BRONZE, completeness=ALL_INVALID),
    _contract("silver.labs_metadata_limits", "name, min_normal, max_normal, unit", "min_normal < max_normal",
              fields=[
                  ("name", "string", False), ("min_normal", "float", False), ("max_normal", "float", False),
                  ("unit", "string", False),
              ],
              freshness=ON_DEMAND, completeness=ALL_TESTS),
    _contract("silver.patients_demographics", "caseid, age", "is_unique(caseid)", "age BETWEEN 0 AND 120",
              "height BETWEEN 40 AND 250 OR height IS NULL", "weight BETWEEN 2 AND 400 OR weight IS NULL",
              fields=[
                  ("caseid", "string", False), ("age", "float", False), ("sex", "string", True), ("height", "float", True),
                  ("weight", "float", True), ("bmi", "float", True), ("asa", "float", True),
              ],
              freshness=AFTER_BRONZE, completeness=MOST_ROWS),
    _contract("silver.patients_surgery_context", "caseid", "is_unique(caseid)",
              fields=[
                  ("caseid", "string", False), ("department", "string", True), ("optype", "string", True), ("dx", "string", True),
                  ("opname", "string", True), ("approach", "string", True), ("ane_type", "string", True),
                  ("icu_days", "float", True),
              ],
              freshness=AFTER_BRONZE, completeness=MOST_ROWS),
    _contract("silver.patients_quarantine", "error_reason", fields=[
                  ("caseid", "string", True), ("error_reason", "string", False),
              ],
              freshness=AFTER_BRONZE, completeness=ALL_INVALID),
    _contract("gold.cross_sensor_drift", "case_id, time, parameter_measured, sensor_id_1, drift_value", "drift_value >= 0",
              fields=[
                  ("case_id", "string", False), ("time", "timestamp", False), ("parameter_measured", "string", False),
                  ("sensor_id_1", "string", False), ("sensor_id_2", "string", True), ("drift_value", "float", False),
              ]),
    _contract("gold.hardware_failures_summary", "case_id, sensor_name, equipment_brand, failure_count", "failure_count >= 0",
              fields=[
                  ("case_id", "string", False), ("sensor_name", "string", False), ("equipment_brand", "string", False),
                  ("error_reason", "string", True), ("failure_count", "integer", False),
              ]),
    _contract("gold.sensor_health_summary",
              "case_id, sensor_name, equipment_brand, null_rate_percentage, frozen_signal_count, noise_spikes_count, "
              "hardware_failures, health_grade",
              "null_rate_percentage >= 0 AND null_rate_percentage <= 100", "frozen_signal_count >= 0", "noise_spikes_count >= 0",
              fields=[
                  ("case_id", "string", False), ("sensor_name", "string", False), ("equipment_brand", "string", False),
                  ("null_rate_percentage", "float", False), ("frozen_signal_count", "integer", False),
                  ("noise_spikes_count", "integer", False), ("hardware_failures", "integer", True),
                  ("health_grade", "string", False),
              ]),
    _contract("gold.sensor_uptime_rates", "surgery_id, sensor_id, uptime_seconds, surgery_seconds, uptime_rate",
              fields=[
                  ("surgery_id", "string", True), ("sensor_id", "string", True), ("uptime_seconds", "number", True),
                  ("surgery_seconds", "number", True), ("uptime_rate", "number", True),
              ]),
    _contract("gold.view_window", "surgery_id, sensor_id, window_start, avg_value, n_samples",
              fields=[
                  ("surgery_id", "string", True), ("sensor_id", "string", True), ("window_start", "timestamp", True),
                  ("avg_value", "number", True), ("stddev_value", "number", True), ("n_samples", "integer", True),
              ]),
    _contract("gold.pre_vs_post_operation", "caseid, lab_test, pre_op_avg, pos_op_avg", "age >= 0 AND age <= 120",
              fields=[
                  ("caseid", "string", False), ("lab_test", "string", False), ("pre_op_avg", "float", False),
                  ("pos_op_avg", "float", False), ("absolute_delta", "float", False), ("age", "number", False),
                  ("sex", "string", True), ("department", "string", True),
              ]),
    _contract("gold.icu_ml_features", "caseid, icu_days", "icu_days >= 0", ("age >= 0 AND age <= 120", "warning"),
              fields=[
                  ("caseid", "string", False), ("age", "float", True), ("sex", "string", True), ("bmi", "float", True),
                  ("asa", "float", True), ("department", "string", True), ("optype", "string", True), ("approach", "string", True),
                  ("ane_type", "string", True), ("preop_hb", "float", True), ("preop_plt", "float", True),
                  ("preop_wbc", "float", True), ("preop_gluc", "float", True), ("preop_cr", "float", True),
                  ("preop_alb", "float", True), ("icu_days", "float", False),
              ]),
]}
