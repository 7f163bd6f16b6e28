"""Cleaning operators and the silver tables, each with the SQL that says the same."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import epoch_seconds, epoch_to_ts, map_labels, normalize_columns, to_numeric
from perispark.operators.filters import BoundsRule, TimeRule, bounds_filter, run_filters, split_valid, time_filter
from perispark.operators.ordering import dedupe_keep_last
from perispark.plans.labs import labs_split
from perispark.plans.patients import patients_split
from perispark.plans.vitals import vitals_clean_quarantine
from perispark.queries import fixtures as fx
from perispark.queries.registry import Registry, with_double_id

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


# ---- names, types, labels ----
@query('SELECT l_orderkey AS case_id, l_quantity AS solar8000_hr, l_tax AS primus_awp FROM {lineitem}')
def normalize_columns_query(spark, sf):
    raw = fx.table(spark, sf, "lineitem").selectExpr("l_orderkey AS `Case ID`", "l_quantity AS `Solar8000/HR`", "l_tax AS `Primus/AWP`")
    return normalize_columns(raw, "sensor")


RAW_TEXT = """SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN CAST(event_id AS VARCHAR(20)) || 'd'
 WHEN 3 THEN ' ' || CAST(event_id AS VARCHAR(20)) || ' ' WHEN 4 THEN '1e3' WHEN 5 THEN NULL WHEN 6 THEN '-.5' WHEN 7 THEN 'NaN'
 ELSE '+' || CAST(event_id AS VARCHAR(20)) || '.25' END AS text FROM {events}"""


@query(f"""SELECT event_id, CASE WHEN regexp_full_match(text, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
 THEN TRY_CAST(trim(ltrim(text, '+ ')) AS DOUBLE) END AS number FROM ({RAW_TEXT})""")
def to_numeric_query(spark, sf):
    return fx.project(spark, sf, RAW_TEXT).select("event_id", to_numeric("text").alias("number"))


@query("SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 250 MILLISECOND AS time FROM {lineitem}")
def epoch_to_ts_query(spark, sf):
    raw = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (epoch_seconds("l_shipdate") + 0.25).alias("t"))
    return raw.select("l_orderkey", "l_linenumber", epoch_to_ts("t").alias("time"))


@query(f"""SELECT subjectid, CASE lower(department) WHEN 'general surgery' THEN 'Cirurgia Geral' WHEN 'gynecology' THEN 'Ginecologia'
 WHEN 'thoracic surgery' THEN 'Cirurgia Torácica' WHEN 'urology' THEN 'Urologia' ELSE department END AS department FROM ({fx.PATIENTS_RAW_SQL})""")
def label_mapping(spark, sf):
    return fx.project(spark, sf, fx.PATIENTS_RAW_SQL).select("subjectid", map_labels("department", fv.DEPARTMENT_LABELS).alias("department"))


# ---- filters ----
@query(f"""SELECT case_id, time, CASE WHEN solar8000_hr > 0 AND solar8000_hr < 48.5 THEN solar8000_hr END AS solar8000_hr,
 CASE WHEN solar8000_art_sbp > 0 AND solar8000_art_sbp < 48.5 THEN solar8000_art_sbp END AS solar8000_art_sbp,
 solar8000_pleth_spo2, primus_awp FROM ({fx.VITALS_RAW_SQL})""")
def bounds_clean(spark, sf):
    return bounds_filter(fx.project(spark, sf, fx.VITALS_RAW_SQL), ["solar8000_hr", "solar8000_art_sbp"], 0, 48.5)[0]


@query(f"""SELECT case_id, time, sensor_name, original_value, 'Out of bounds (min: 0, max: 48.5)' AS error_reason FROM (
 SELECT case_id, time, 'solar8000_hr' AS sensor_name, solar8000_hr AS original_value FROM ({fx.VITALS_RAW_SQL}) UNION ALL
 SELECT case_id, time, 'solar8000_pleth_spo2', solar8000_pleth_spo2 FROM ({fx.VITALS_RAW_SQL}))
 WHERE original_value <= 0 OR original_value >= 48.5""")
def bounds_quarantine(spark, sf):
    return bounds_filter(fx.project(spark, sf, fx.VITALS_RAW_SQL), ["solar8000_hr", "solar8000_pleth_spo2"], 0, 48.5)[1]


@query(f"""SELECT case_id, time, 'time' AS sensor_name, date_diff('microsecond', TIMESTAMP '1970-01-01 00:00:00', time) / 1e6 AS original_value,
 CASE WHEN time IS NULL THEN 'Time is Null' ELSE 'Future Date (> 2000-06-01)' END AS error_reason FROM ({fx.VITALS_RAW_SQL})
 WHERE time IS NULL OR time > TIMESTAMP '2000-06-01 00:00:00'""")
def time_anomaly(spark, sf):
    return time_filter(fx.project(spark, sf, fx.VITALS_RAW_SQL), limit=dt.datetime(2000, 6, 1), limit_text="2000-06-01")[1]


@query(f"""WITH v AS ({fx.VITALS_RAW_SQL}), t AS (SELECT *, CASE WHEN time > TIMESTAMP '2000-06-01 00:00:00' THEN NULL ELSE time END AS kept FROM v)
 SELECT case_id, time, 'time' AS sensor_name, date_diff('microsecond', TIMESTAMP '1970-01-01 00:00:00', time) / 1e6 AS original_value,
 CASE WHEN time IS NULL THEN 'Time is Null' ELSE 'Future Date (> 2000-06-01)' END AS error_reason FROM t WHERE kept IS NULL
 UNION ALL SELECT case_id, kept, 'solar8000_hr', solar8000_hr, 'Out of bounds (min: 0, max: None)' FROM t WHERE solar8000_hr <= 0
 UNION ALL SELECT case_id, kept, 'solar8000_hr', solar8000_hr, 'Out of bounds (min: 5, max: 40)' FROM t WHERE solar8000_hr > 0 AND (solar8000_hr <= 5 OR solar8000_hr >= 40)""")
def filter_chain_quarantine(spark, sf):
    rules = [TimeRule(limit=dt.datetime(2000, 6, 1), limit_text="2000-06-01"), BoundsRule(["solar8000_hr"], 0), BoundsRule(["solar8000_hr"], 5, 40)]
    return run_filters(fx.project(spark, sf, fx.VITALS_RAW_SQL), rules)[1]


@query(f"""WITH v AS ({fx.VITALS_RAW_SQL}), b AS (SELECT *, CASE WHEN solar8000_hr <= 0 THEN NULL ELSE solar8000_hr END AS hr FROM v)
 SELECT case_id, time, 'solar8000_hr' AS sensor_name, solar8000_hr AS original_value, 'Out of bounds (min: 0, max: None)' AS error_reason FROM b WHERE solar8000_hr <= 0
 UNION ALL SELECT case_id, time, 'primus_awp', primus_awp, 'Pressure without pulse' FROM b WHERE primus_awp > 0 AND (hr IS NULL OR hr < 10)
 UNION ALL SELECT case_id, time, 'solar8000_hr', hr, 'Out of bounds (min: None, max: 45)' FROM b WHERE NOT (primus_awp > 0 AND (hr IS NULL OR hr < 10)) AND hr >= 45""")
def plugin_filter_quarantine(spark, sf):
    """A rule of one's own between two built-in ones: it removes whole rows and logs them itself."""
    def no_pulse(frame):
        bad = (F.col("primus_awp") > 0) & (F.col("solar8000_hr").isNull() | (F.col("solar8000_hr") < 10))
        clean, log = split_valid(frame, ~bad, "Pressure without pulse")
        return clean, log.select("case_id", "time", F.lit("primus_awp").alias("sensor_name"), F.col("primus_awp").alias("original_value"), "error_reason")

    return run_filters(fx.project(spark, sf, fx.VITALS_RAW_SQL), [BoundsRule(["solar8000_hr"], 0), no_pulse, BoundsRule(["solar8000_hr"], None, 45)])[1]


def _raw_vitals(spark, sf):
    """The raw feed: epoch seconds and vendor column names."""
    return fx.project(spark, sf, fx.VITALS_RAW_SQL).select(
        F.col("case_id").alias("Case_ID"), epoch_seconds("time").alias("Time"), F.col("solar8000_hr").alias("Solar8000/HR"),
        F.col("solar8000_art_sbp").alias("Solar8000/ART_SBP"), F.col("solar8000_pleth_spo2").alias("Solar8000/PLETH_SPO2"),
        F.col("primus_awp").alias("Primus/AWP"))


@query(f"""SELECT case_id, time, CASE WHEN solar8000_hr > 0 THEN solar8000_hr END AS solar8000_hr,
 CASE WHEN solar8000_art_sbp > 0 THEN solar8000_art_sbp END AS solar8000_art_sbp,
 CASE WHEN solar8000_pleth_spo2 > -0.001 AND solar8000_pleth_spo2 < 100.001 THEN solar8000_pleth_spo2 END AS solar8000_pleth_spo2,
 CASE WHEN primus_awp > -5 THEN primus_awp END AS primus_awp FROM ({fx.VITALS_RAW_SQL})""")
def vitals_clean(spark, sf):
    return vitals_clean_quarantine(_raw_vitals(spark, sf))[0]


@query(f"""WITH v AS ({fx.VITALS_RAW_SQL})
 SELECT case_id, time, 'solar8000_hr' AS sensor_name, solar8000_hr AS original_value, 'Out of bounds (min: 0, max: None)' AS error_reason FROM v WHERE solar8000_hr <= 0
 UNION ALL SELECT case_id, time, 'solar8000_art_sbp', solar8000_art_sbp, 'Out of bounds (min: 0, max: None)' FROM v WHERE solar8000_art_sbp <= 0
 UNION ALL SELECT case_id, time, 'solar8000_pleth_spo2', solar8000_pleth_spo2, 'Out of bounds (min: -0.001, max: 100.001)' FROM v
 WHERE solar8000_pleth_spo2 <= -0.001 OR solar8000_pleth_spo2 >= 100.001
 UNION ALL SELECT case_id, time, 'primus_awp', primus_awp, 'Out of bounds (min: -5.0, max: None)' FROM v WHERE primus_awp <= -5""")
def vitals_quarantine(spark, sf):
    return vitals_clean_quarantine(_raw_vitals(spark, sf))[1]


# ---- labs ----
LAB_VALID = "caseid IS NOT NULL AND dt IS NOT NULL AND result IS NOT NULL AND result >= 0"
LABS_RESULTS_SQL = f"""SELECT caseid, dt, name, result, tie, CASE WHEN dt < 0 THEN 'PRE_OP' ELSE 'POS_OP' END AS surgery_phase,
 row_number() OVER (PARTITION BY caseid, name, CASE WHEN dt < 0 THEN 'PRE_OP' ELSE 'POS_OP' END ORDER BY dt DESC, tie DESC) = 1 AS is_most_recent
 FROM ({fx.LABS_RAW_SQL}) WHERE {LAB_VALID}"""


def labs(spark, sf):
    return labs_split(fx.labs_raw(spark, sf), tie=["tie"])


@query(f"SELECT caseid, dt, name, result, tie FROM ({fx.LABS_RAW_SQL}) WHERE {LAB_VALID}")
def labs_valid(spark, sf):
    valid = F.col("caseid").isNotNull() & F.col("dt").isNotNull() & (F.col("result") >= 0)
    return split_valid(fx.labs_raw(spark, sf), valid, fv.LAB_REASON)[0]


@query(f"SELECT CAST(caseid AS DOUBLE) AS caseid, dt, name, result, tie, 'Valor laboratorial nulo ou negativo' AS error_reason FROM ({fx.LABS_RAW_SQL}) WHERE NOT ({LAB_VALID})")
def labs_quarantine(spark, sf):
    return with_double_id(labs(spark, sf)[1])


@query(LABS_RESULTS_SQL)
def labs_results(spark, sf):
    return labs(spark, sf)[0]


# ---- patients ----
DEDUPED_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY ord DESC, subjectid DESC) AS rn
 FROM ({fx.PATIENTS_RAW_SQL})) WHERE rn = 1"""
PATIENT_VALID = """caseid IS NOT NULL AND age IS NOT NULL AND age BETWEEN 0 AND 120 AND (height IS NULL OR height BETWEEN 40 AND 250)
 AND (weight IS NULL OR weight BETWEEN 2 AND 400)"""
DEMOGRAPHICS_SQL = f"SELECT caseid, age, upper(trim(sex)) AS sex, height, weight, bmi, asa FROM ({DEDUPED_SQL}) WHERE {PATIENT_VALID}"
SURGERY_SQL = f"SELECT caseid, department, optype, dx, opname, approach, ane_type, icu_days FROM ({DEDUPED_SQL}) WHERE {PATIENT_VALID}"


def patients(spark, sf):
    return patients_split(fx.project(spark, sf, fx.PATIENTS_RAW_SQL), order=["ord", "subjectid"])


@query(f"SELECT CAST(caseid AS DOUBLE) AS caseid, subjectid, age, ord FROM ({DEDUPED_SQL})")
def dedupe_keep_last_query(spark, sf):
    rows = fx.project(spark, sf, fx.PATIENTS_RAW_SQL).select("caseid", "subjectid", "age", "ord")
    return with_double_id(dedupe_keep_last(rows, ["caseid"], ["ord", "subjectid"]))


@query(DEMOGRAPHICS_SQL)
def patients_demographics(spark, sf):
    return patients(spark, sf)[0]


@query(SURGERY_SQL)
def patients_surgery(spark, sf):
    return patients(spark, sf)[1]


@query(f"""SELECT * EXCLUDE (rn, caseid), CAST(caseid AS DOUBLE) AS caseid, 'Erro biológico (idade/peso/altura) ou ID inválido' AS error_reason FROM ({DEDUPED_SQL}) WHERE NOT ({PATIENT_VALID})""")
def patients_quarantine(spark, sf):
    return with_double_id(patients(spark, sf)[2])

