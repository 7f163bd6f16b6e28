"""Projections of the driver tables onto the clinical inputs, as SQL text that Spark and DuckDB both run.

Tables are named in braces: :func:`project` hands Spark the parquet frames, :func:`plain` leaves bare names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# event types stand for two comparable pairs of sensors and one sensor outside the dimension
SENSOR_CASE = """CASE event_type WHEN 'click' THEN 'solar8000_hr' WHEN 'view' THEN 'solar8000_pleth_hr'
 WHEN 'purchase' THEN 'primus_awp' WHEN 'error' THEN 'solar8000_vent_mawp' ELSE 'bis_sqi' END"""
SENSORS = ["solar8000_hr", "solar8000_pleth_hr", "primus_awp", "solar8000_vent_mawp", "bis_sqi"]

READINGS_SQL = f"""SELECT user_id AS case_id, {SENSOR_CASE} AS sensor_name, ts AS time,
 CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN CAST(floor(value / 10) AS DOUBLE) ELSE value END AS value,
 event_id AS tie FROM {{events}}"""

LONG_SQL = f"SELECT case_id AS surgery_id, time AS ts, sensor_name AS sensor_id, value, tie FROM ({READINGS_SQL}) WHERE value IS NOT NULL"

# whole days as sampling interval: readings of one day become one wide row
WIDE_SQL = f"""SELECT case_id, CAST(date_trunc('day', time) AS TIMESTAMP) AS time, {", ".join(
    f"max(CASE WHEN sensor_name = '{s}' THEN value END) AS {s}" for s in SENSORS)}
 FROM ({READINGS_SQL}) GROUP BY case_id, date_trunc('day', time)"""

QUARANTINE_SQL = f"""SELECT user_id AS case_id, ts AS time, {SENSOR_CASE} AS sensor_name, value AS original_value,
 CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 < 2 THEN 'Out of bounds (min: 0, max: None)'
 WHEN event_id % 5 = 2 THEN 'Signal loss' ELSE 'Cable fault' END AS error_reason
 FROM {{events}}"""

VITALS_RAW_SQL = """SELECT l_orderkey AS case_id,
 CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_shipdate END AS time, l_quantity - 1 AS solar8000_hr,
 l_extendedprice AS solar8000_art_sbp, l_discount * 1010 AS solar8000_pleth_spo2, l_tax * 100 - 5 AS primus_awp FROM {lineitem}"""

LAB_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'hb' WHEN '2-HIGH' THEN 'plt' WHEN '3-MEDIUM' THEN 'wbc'
 WHEN '4-NOT SPECIFIED' THEN 'gluc' ELSE 'na' END"""

LABS_RAW_SQL = f"""SELECT CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS caseid,
 CAST(CAST(date_diff('day', TIMESTAMP '1998-04-01 00:00:00', o_orderdate) AS BIGINT) AS DOUBLE) AS dt, {LAB_CASE} AS name,
 CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN -1.0 WHEN o_orderkey % 41 = 0 THEN 0.0
 ELSE o_totalprice END AS result, o_orderkey AS tie FROM {{orders}}"""

PATIENTS_RAW_SQL = """SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS caseid,
 c_custkey + 100000 AS subjectid, c_acctbal / 100 + CAST(ord - 1 AS DOUBLE) AS age,
 CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE '  ' || lower(substr(c_mktsegment, 1, 1)) || ' ' END AS sex,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(60 + c_nationkey * 8 AS DOUBLE) END AS height,
 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(1 + c_custkey % 410 AS DOUBLE) END AS weight,
 CAST(15 + c_custkey % 23 AS DOUBLE) AS bmi, CAST(1 + c_custkey % 5 AS DOUBLE) AS asa,
 CASE c_nationkey % 5 WHEN 0 THEN 'General surgery' WHEN 1 THEN 'Gynecology' WHEN 2 THEN 'Thoracic surgery'
 WHEN 3 THEN 'Urology' ELSE n_name END AS department,
 c_mktsegment AS optype, c_name AS dx, 'operation ' || CAST(c_custkey % 9 AS VARCHAR(9)) AS opname,
 CASE WHEN c_custkey % 3 = 0 THEN 'Open' WHEN c_custkey % 3 = 1 THEN 'Videoscopic' ELSE NULL END AS approach,
 CASE WHEN c_acctbal > 5000 THEN 'General' ELSE 'Spinal' END AS ane_type,
 CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_acctbal > 4000 THEN CAST(c_nationkey % 5 AS DOUBLE) ELSE 0.0 END AS icu_days, ord
 FROM (SELECT *, 1 AS ord FROM {customer} UNION ALL SELECT *, 2 AS ord FROM {customer} WHERE c_custkey % 7 = 0) c
 JOIN {nation} ON c_nationkey = n_nationkey"""

PREDICTIONS_SQL = "SELECT quality AS y, toxic AS yhat FROM {labels} WHERE quality IS NOT NULL AND toxic IS NOT NULL"

SCORES_SQL = """SELECT CASE WHEN value > 50 THEN 1 ELSE 0 END AS y,
 CAST((event_id * 7919) % 97 AS DOUBLE) / 97 + least(value, 200.0) / 400 AS score, event_id AS tie FROM {events}"""

CURRENT_SQL = """SELECT c_custkey AS caseid, c_custkey + 100000 AS subjectid, c_acctbal AS age,
 CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS sex, c_name AS dx, 'old' AS source_system FROM {customer} WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 1"""
INCOMING_SQL = """SELECT c_custkey AS caseid, c_custkey + 100000 AS subjectid,
 CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS age,
 CASE WHEN c_custkey % 28 = 0 THEN NULL ELSE c_mktsegment END AS sex, c_name AS dx, 'new' AS source_system FROM {customer} WHERE c_custkey % 2 = 0"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(sql: str) -> str:
    """SQL text with bare table names instead of placeholders."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def project(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """The projection ``sql`` over the driver tables it names in braces, as a lazy DataFrame."""
    return spark.sql(sql, **{name: table(spark, sf, name) for name in set(re.findall(r"\{(\w+)\}", sql))})


def wide(spark: SparkSession, sf: str) -> DataFrame:
    frame = project(spark, sf, WIDE_SQL)
    return frame.withColumn("time", frame["time"].cast("timestamp_ntz"))


def labs_raw(spark: SparkSession, sf: str) -> DataFrame:
    sql = LABS_RAW_SQL.replace("date_diff('day', ", "timestampdiff(DAY, ").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return project(spark, sf, sql)
