"""Sensor operators, gold sensor tables and their dashboard, each with the SQL that says the same."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from perispark.operators import ordering as o
from perispark.operators import sensors as s
from perispark.operators.joins import enrich_brand, keep_active
from perispark.operators.reshape import to_long, to_long_clean
from perispark.plans import reports
from perispark.plans.health import append_clean, refresh_chunks, stored_health
from perispark.queries import fixtures as fx
from perispark.queries.registry import Registry, rounded
from perispark.session import use_checkpoint_dir
from perispark.sources.dims import sensors_metadata
from perispark.sources.lake import Lake

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

DAY = 86_400
SAMPLE = 2 * DAY  # sampling interval that gives the event table a spread of grades
GAP = 2 * DAY
CHUNK = 7 * DAY  # windows of a week, so that results depend on readings in neighbouring chunks
NAMES = ["case_id", "sensor_name"]

DIM_SQL = """SELECT * FROM (VALUES ('solar8000_hr', 'Heart Rate', 'Solar8000', 'bpm'), ('solar8000_pleth_hr', 'Heart Rate', 'Solar8000', 'bpm'),
 ('primus_awp', 'Airway Pressure', 'Primus', 'mbar'), ('solar8000_vent_mawp', 'Airway Pressure', 'Solar8000', 'mbar'))
 AS d(sensor_id, parameter_measured, equipment_brand, unit_of_measure)"""


def readings(spark, sf):
    return fx.project(spark, sf, fx.READINGS_SQL)


def long_readings(spark, sf):
    return fx.project(spark, sf, fx.LONG_SQL)


def quarantine(spark, sf):
    return fx.project(spark, sf, fx.QUARANTINE_SQL)


# ---- reshape ----
def melted(value: str, name: str, where: str = "") -> str:
    return " UNION ALL ".join(f"SELECT case_id, time, '{c}' AS {name}, {c} AS {value} FROM w{where.format(c=c)}" for c in fx.SENSORS)


@query(f"WITH w AS ({fx.WIDE_SQL}) {melted('reading', 'sensor_name')}")
def wide_to_long(spark, sf):
    return to_long(fx.wide(spark, sf), ["case_id", "time", "ingest_time"])


@query(f"""WITH w AS ({fx.WIDE_SQL}) {melted('reading', 'sensor_name')} UNION ALL
 SELECT case_id, time, 'bis_text', CASE WHEN case_id % 7 = 0 THEN NULL ELSE CAST(case_id AS DOUBLE) END FROM w""")
def wide_to_long_text(spark, sf):
    """A sensor that came as text keeps the cells that are numbers."""
    text = F.when(F.col("case_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("case_id").cast("string"))
    return to_long(fx.wide(spark, sf).withColumn("bis_text", text), ["case_id", "time", "ingest_time"])


@query(f"""WITH w AS ({fx.WIDE_SQL}) SELECT case_id AS surgery_id, time AS ts, sensor_id, value FROM
 ({melted('value', 'sensor_id', ' WHERE {c} IS NOT NULL')})""")
def wide_to_long_clean(spark, sf):
    return to_long_clean(fx.wide(spark, sf).withColumn("source_system", F.lit("VitalDB")))


# ---- dimension ----
@query(f"""SELECT sensor_name, any_value(parameter_measured) AS parameter_measured, any_value(equipment_brand) AS equipment_brand,
 any_value(unit_of_measure) AS unit_of_measure, count(value) AS readings FROM ({fx.READINGS_SQL}) LEFT JOIN ({DIM_SQL}) ON sensor_name = sensor_id
 GROUP BY sensor_name""")
def dim_sensors(spark, sf):
    """Which observed sensors the shipped dimension describes."""
    counted = readings(spark, sf).groupBy("sensor_name").agg(F.count("value").alias("readings"))
    dim = sensors_metadata(spark)
    return counted.join(dim, F.col("sensor_name") == F.col("sensor_id"), "left").select(
        "sensor_name", "parameter_measured", "equipment_brand", "unit_of_measure", "readings")


BRAND = "CASE sensor_name WHEN 'solar8000_hr' THEN 'Solar8000' WHEN 'solar8000_pleth_hr' THEN 'Solar8000' WHEN 'primus_awp' THEN 'Primus' WHEN 'solar8000_vent_mawp' THEN 'Solar8000' ELSE 'BIS' END"


@query(f"SELECT case_id, time, sensor_name, value, tie, {BRAND} AS equipment_brand FROM ({fx.READINGS_SQL})")
def brand_enrichment(spark, sf):
    return enrich_brand(readings(spark, sf), sensors_metadata(spark))


# ---- activity and anomalies ----
ACTIVITY = f"""SELECT *, 100 - uptime_percentage AS null_rate_percentage FROM (SELECT *,
 least(valid_readings / ((sensor_active_seconds - 1) / {SAMPLE}.0 + 1) * 100, 100.0) AS uptime_percentage FROM (
 SELECT case_id, sensor_name, count(value) AS valid_readings, date_diff('microsecond', min(time), max(time)) / 1e6 + 1 AS sensor_active_seconds
 FROM %s WHERE value IS NOT NULL GROUP BY case_id, sensor_name))"""


@query(f"""WITH r AS ({fx.READINGS_SQL}) SELECT case_id, sensor_name, valid_readings, round(sensor_active_seconds, 6) AS sensor_active_seconds,
 round(uptime_percentage, 6) AS uptime_percentage, round(null_rate_percentage, 6) AS null_rate_percentage FROM ({ACTIVITY % 'r'})""")
def sensor_activity(spark, sf):
    return rounded(s.sensor_activity(readings(spark, sf), sample_seconds=SAMPLE), "sensor_active_seconds", "uptime_percentage", "null_rate_percentage")


@query(f"""WITH r AS ({fx.READINGS_SQL}) SELECT * FROM r WHERE (case_id, sensor_name) IN
 (SELECT (case_id, sensor_name) FROM r WHERE value > 100)""")
def active_readings(spark, sf):
    rows = readings(spark, sf)
    return keep_active(rows, rows.where("value > 100").select(*NAMES).distinct(), NAMES)


ANOMALIES = """SELECT case_id, sensor_name, count(CASE WHEN value = prev THEN 1 END) AS frozen_signal_count,
 count(CASE WHEN abs(value - prev) / (abs(prev) + 1e-9) > 0.20 THEN 1 END) AS noise_spikes_count FROM (
 SELECT *, lag(value) OVER (PARTITION BY case_id, sensor_name ORDER BY {order}) AS prev FROM {source})
 GROUP BY case_id, sensor_name HAVING count(value) > 0"""


@query(f"WITH r AS ({fx.READINGS_SQL}) {ANOMALIES.format(order='time, tie', source='r')}")
def signal_anomalies(spark, sf):
    return s.signal_anomalies(readings(spark, sf), tie="tie", chunk_seconds=CHUNK)


# ---- failures ----
FAILURES_SQL = f"""SELECT case_id, sensor_name, {BRAND} AS equipment_brand, error_reason, count(*) AS failure_count FROM ({fx.QUARANTINE_SQL})
 WHERE error_reason IS NOT NULL GROUP BY case_id, sensor_name, error_reason"""
REAL_SQL = f"""SELECT case_id, sensor_name, count(*) AS hardware_failures FROM ({fx.QUARANTINE_SQL})
 WHERE NOT coalesce(lower(error_reason) LIKE '%out of bounds%', FALSE) GROUP BY case_id, sensor_name"""


def failures(spark, sf):
    return s.hardware_failures(quarantine(spark, sf), sensors_metadata(spark))


@query(FAILURES_SQL)
def hardware_failures(spark, sf):
    return failures(spark, sf)


@query(REAL_SQL)
def real_failures(spark, sf):
    return s.real_failures(quarantine(spark, sf))


# ---- health ----
def thresholds(a, b, c, d, standard):
    """Last matching class wins, so classes are tested from the last to the first."""
    return f"""CASE WHEN regexp_matches(lower(sensor_name), 'rate|set|ce|ct') THEN {d} WHEN regexp_matches(lower(sensor_name), 'ecg|wav|pleth') THEN {c}
 WHEN regexp_matches(lower(sensor_name), 'primus|gas|fms|temp|mac|co2|des|sevo') THEN {b} WHEN regexp_matches(lower(sensor_name), 'nibp') THEN {a} ELSE {standard} END"""


GRADED = f"""SELECT *, CASE WHEN hw > 5 OR null_rate_percentage > max_n THEN 'Falha Crítica'
 WHEN null_rate_percentage > max_n * 0.7 OR frozen_signal_count / valid_readings * 100 > max_f OR noise_spikes_count / valid_readings * 100 > max_s OR hw > 1 THEN 'Degradado'
 WHEN hardware_failures > 0 OR null_rate_percentage > 2 THEN 'Aceitável' ELSE 'Excelente' END AS health_grade FROM (
 SELECT *, hardware_failures / (sensor_active_seconds + 1e-9) * 100 AS hw, {thresholds(99.0, 99.0, 15.0, 15.0, 15.0)} AS max_n,
 {thresholds(10.0, 10.0, 10.0, 100.0, 10.0)} AS max_f, {thresholds(5.0, 5.0, 100.0, 5.0, 5.0)} AS max_s FROM (%s))"""

HEALTH_SQL = f"""WITH w AS ({fx.WIDE_SQL}), long AS (SELECT case_id, time, sensor_name, value FROM ({melted('value', 'sensor_name')})),
 act AS ({ACTIVITY % 'long'}), ano AS ({ANOMALIES.format(order='time', source='long')}), hwf AS ({REAL_SQL}),
 joined AS (SELECT act.*, frozen_signal_count, noise_spikes_count, coalesce(hardware_failures, 0) AS hardware_failures FROM act
 JOIN ano USING (case_id, sensor_name) LEFT JOIN hwf USING (case_id, sensor_name))
 SELECT case_id, sensor_name, {BRAND} AS equipment_brand, null_rate_percentage, frozen_signal_count, noise_spikes_count, hardware_failures, health_grade
 FROM ({GRADED % 'SELECT * FROM joined'})"""


def health(spark, sf):
    return s.sensor_health(fx.wide(spark, sf), quarantine(spark, sf), sensors_metadata(spark), tie="time", sensors=fx.SENSORS,
                           sample_seconds=SAMPLE, chunk_seconds=CHUNK)


@query(f"SELECT * REPLACE (round(null_rate_percentage, 6) AS null_rate_percentage) FROM ({HEALTH_SQL})")
def sensor_health(spark, sf):
    return rounded(health(spark, sf), "null_rate_percentage")


@query(f"SELECT * REPLACE (round(null_rate_percentage, 6) AS null_rate_percentage) FROM ({HEALTH_SQL})")
def health_refreshed(spark, sf):
    """The same grades from stored chunk states: all days but the last, then the last one appended."""
    use_checkpoint_dir(spark)
    wide = fx.wide(spark, sf).withColumn("day", F.to_date("time")).checkpoint()
    last = wide.agg(F.max("day")).first()[0]
    lake = Lake(spark, f"{use_checkpoint_dir(spark)}/health-{uuid.uuid4()}")
    for part in (F.col("day") < F.lit(last), F.col("day") == F.lit(last)):
        batch = wide.where(part).drop("day")
        append_clean(lake, batch)
        refresh_chunks(lake, batch, tie="time", sensors=fx.SENSORS, chunk_seconds=DAY)
    return rounded(stored_health(lake, quarantine(spark, sf), sensors_metadata(spark), sample_seconds=SAMPLE), "null_rate_percentage")


READING_HEALTH_SQL = f"""WITH r AS ({fx.READINGS_SQL}), act AS ({ACTIVITY % 'r'}), ano AS ({ANOMALIES.format(order='time, tie', source='r')}), hwf AS ({REAL_SQL}),
 joined AS (SELECT act.*, frozen_signal_count, noise_spikes_count, coalesce(hardware_failures, 0) AS hardware_failures FROM act
 JOIN ano USING (case_id, sensor_name) LEFT JOIN hwf USING (case_id, sensor_name))
 SELECT case_id, sensor_name, {BRAND} AS equipment_brand, round(null_rate_percentage, 6) AS null_rate_percentage, frozen_signal_count, noise_spikes_count,
 hardware_failures, health_grade FROM ({GRADED % 'SELECT * FROM joined'})"""


@query(READING_HEALTH_SQL)
def reading_health(spark, sf):
    """Grades from all single readings, repeated instants included."""
    profile = s.signal_profile(readings(spark, sf), tie="tie", chunk_seconds=CHUNK)
    return rounded(s.grade_profile(profile, quarantine(spark, sf), sensors_metadata(spark), SAMPLE), "null_rate_percentage")


GRADE_INPUT = """SELECT event_id AS case_id, CASE event_id % 6 WHEN 0 THEN 'nibp_sbp' WHEN 1 THEN 'primus_etco2' WHEN 2 THEN 'ecg_ii'
 WHEN 3 THEN 'bis_rate_co2' WHEN 4 THEN 'set_awp' ELSE 'bis_bis' END AS sensor_name, CAST(event_id % 23 AS DOUBLE) AS null_rate_percentage,
 event_id % 13 AS frozen_signal_count, event_id % 7 AS noise_spikes_count, CASE WHEN event_id % 11 = 0 THEN event_id % 17 ELSE 0 END AS hardware_failures,
 CAST(90 + event_id % 30 AS DOUBLE) AS sensor_active_seconds, 80 + event_id % 10 AS valid_readings FROM {events}"""


@query(f"SELECT case_id, sensor_name, health_grade FROM ({GRADED % GRADE_INPUT})")
def health_grade(spark, sf):
    return s.health_grade(fx.project(spark, sf, GRADE_INPUT)).select("case_id", "sensor_name", "health_grade")


# ---- drift ----
DRIFT_SQL = f"""WITH w AS ({fx.WIDE_SQL}) SELECT case_id, time, 'Heart Rate' AS parameter_measured, 'solar8000_hr' AS sensor_id_1,
 'solar8000_pleth_hr' AS sensor_id_2, abs(solar8000_hr - solar8000_pleth_hr) AS drift_value FROM w
 WHERE solar8000_hr IS NOT NULL AND solar8000_pleth_hr IS NOT NULL UNION ALL
 SELECT case_id, time, 'Airway Pressure', 'primus_awp', 'solar8000_vent_mawp', abs(primus_awp - solar8000_vent_mawp) FROM w
 WHERE primus_awp IS NOT NULL AND solar8000_vent_mawp IS NOT NULL"""


@query(f"SELECT * REPLACE (round(drift_value, 6) AS drift_value) FROM ({DRIFT_SQL})")
def cross_sensor_drift(spark, sf):
    return rounded(s.cross_sensor_drift(fx.wide(spark, sf)), "drift_value")


@query(f"SELECT parameter_measured, round(avg(drift_value), 6) AS mean_drift FROM ({DRIFT_SQL}) GROUP BY parameter_measured")
def drift_by_parameter(spark, sf):
    return rounded(reports.drift_by_parameter(s.cross_sensor_drift(fx.wide(spark, sf))), "mean_drift")


# ---- sessions, uptime, windows ----
SEGMENTS_SQL = f"""SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('microsecond', prev, ts) / 1e6 > {GAP} THEN 1 ELSE 0 END)
 OVER (PARTITION BY surgery_id, sensor_id ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS seg_id FROM (SELECT surgery_id, sensor_id, ts, tie, value,
 lag(ts) OVER (PARTITION BY surgery_id, sensor_id ORDER BY ts, tie) AS prev FROM ({fx.LONG_SQL}))"""


@query(f"SELECT surgery_id, sensor_id, ts, tie, value, CAST(seg_id AS BIGINT) AS seg_id FROM ({SEGMENTS_SQL})")
def gap_segments(spark, sf):
    return o.gap_segments(long_readings(spark, sf), ["surgery_id", "sensor_id"], "ts", GAP)


@query(f"""SELECT surgery_id, sensor_id, CAST(seg_id AS BIGINT) AS seg_id, min(ts) AS seg_start, max(ts) AS seg_end,
 round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 6) AS seg_seconds FROM ({SEGMENTS_SQL}) GROUP BY surgery_id, sensor_id, seg_id""")
def session_spans(spark, sf):
    return rounded(o.segment_spans(long_readings(spark, sf), ["surgery_id", "sensor_id"], "ts", GAP), "seg_seconds")


@query(f"""WITH r AS ({fx.LONG_SQL}), seg AS (SELECT surgery_id, sensor_id, seg_id, date_diff('microsecond', min(ts), max(ts)) AS micros
 FROM ({SEGMENTS_SQL}) GROUP BY surgery_id, sensor_id, seg_id), up AS (SELECT surgery_id, sensor_id, sum(micros) / 1e6 AS uptime_seconds FROM seg GROUP BY surgery_id, sensor_id),
 span AS (SELECT surgery_id, nullif(date_diff('microsecond', min(ts), max(ts)) / 1e6, 0) AS surgery_seconds FROM r GROUP BY surgery_id)
 SELECT surgery_id, sensor_id, uptime_seconds, surgery_seconds,
 round(uptime_seconds / surgery_seconds, 6) AS uptime_rate FROM up LEFT JOIN span USING (surgery_id)""")
def sensor_uptime(spark, sf):
    return rounded(s.sensor_uptime(long_readings(spark, sf), GAP), "uptime_rate")


def window_sql(minutes, extra=""):
    return f"""SELECT surgery_id, sensor_id, time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start,
 round(avg(value), 6) AS avg_value, round(stddev_samp(value), 6) AS stddev_value, count(value) AS n_samples{extra} FROM ({fx.LONG_SQL})
 GROUP BY surgery_id, sensor_id, time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00')"""


@query(window_sql(1440))
def view_window(spark, sf):
    return rounded(s.view_window(long_readings(spark, sf), 1440), "avg_value", "stddev_value")


@query(f"""SELECT *, round(n_critical / n_samples, 6) AS pct_critical FROM (
 {window_sql(1440, ", count(CASE WHEN value < 5 OR value > 90 THEN 1 END) AS n_critical")})""")
def view_window_critical(spark, sf):
    return rounded(s.view_window(long_readings(spark, sf), 1440, 5, 90), "avg_value", "stddev_value", "pct_critical")


@query(f"""WITH r AS ({fx.READINGS_SQL}) SELECT *, round(avg(value) OVER w, 6) AS moving_avg, round(stddev_samp(value) OVER w, 6) AS moving_std FROM r
 WINDOW w AS (PARTITION BY case_id, sensor_name ORDER BY time, tie ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def signal_smoothing(spark, sf):
    return rounded(o.signal_smoothing(readings(spark, sf), NAMES, "time", "value", "tie", 20, CHUNK), "moving_avg", "moving_std")


# ---- dashboard ----
@query(f"""SELECT equipment_brand, error_reason, total_failures, round(total_failures / sum(total_failures) OVER (PARTITION BY equipment_brand) * 100, 2) AS failure_pct
 FROM (SELECT equipment_brand, error_reason, CAST(sum(failure_count) AS DOUBLE) AS total_failures FROM ({FAILURES_SQL})
 WHERE equipment_brand IN ('Solar8000', 'BIS') GROUP BY equipment_brand, error_reason)""")
def failures_by_brand(spark, sf):
    return reports.failures_by_brand(failures(spark, sf), ["Solar8000", "BIS"])


@query(f"SELECT trim(health_grade) AS health_grade, count(sensor_name) AS sensors FROM ({HEALTH_SQL}) GROUP BY 1")
def grade_distribution(spark, sf):
    return reports.grade_distribution(health(spark, sf))


@query(f"""SELECT case_id, sensor_name, frozen_signal_count, noise_spikes_count, hardware_failures FROM ({HEALTH_SQL})
 WHERE health_grade IN ('Degradado', 'Falha Crítica') ORDER BY frozen_signal_count + noise_spikes_count + hardware_failures DESC, case_id, sensor_name LIMIT 10""")
def noisiest_sensors(spark, sf):
    return reports.noisiest_sensors(health(spark, sf))


@query(f"SELECT health_grade, case_id, sensor_name, equipment_brand, round(null_rate_percentage, 1) AS null_pct FROM ({HEALTH_SQL})")
def intervention_list(spark, sf):
    return reports.intervention_list(health(spark, sf))


@query(f"SELECT DISTINCT {BRAND} AS equipment_brand FROM ({fx.READINGS_SQL}) WHERE value IS NOT NULL")
def brand_list(spark, sf):
    return reports.distinct_values(health(spark, sf), "equipment_brand")
