import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.operators import sensors as s
from perispark.operators.joins import keep_active
from perispark.operators.reshape import require_rows, to_long, to_long_clean
from perispark.sources.dims import sensors_metadata
from tests.conftest import rows
from tests.test_ordering import KEYS, SCHEMA, at, groups, skewed

EMPTY_LOG = "case_id long, time timestamp_ntz, sensor_name string, original_value double, error_reason string"


def brute_profile(grouped, spike=0.2):
    out = {}
    for key, group in grouped.items():
        valid = [r for r in group if r[3] is not None]
        frozen = jumps = 0
        for a, b in zip(group, group[1:]):
            if a[3] is None or b[3] is None:
                continue
            frozen += a[3] == b[3]
            jumps += abs(b[3] - a[3]) / (abs(a[3]) + 1e-9) > spike
        if valid:
            out[key] = (len(valid), (valid[-1][2] - valid[0][2]).total_seconds() + 1, frozen, jumps)
    return out


def profile_of(df):
    return {(r.case_id, r.sensor_name): (r.valid_readings, r.sensor_active_seconds, r.frozen_signal_count, r.noise_spikes_count)
            for r in df.where("valid_readings > 0").collect()}


@pytest.mark.parametrize("chunk", [1, 97, 1000, 100_000])
def test_profile_does_not_depend_on_chunks(spark, chunk):
    data = skewed()
    df = spark.createDataFrame(data, SCHEMA)
    assert profile_of(s.signal_profile(df, tie="tie", chunk_seconds=chunk)) == brute_profile(groups(data))


@pytest.mark.parametrize("chunk", [97, 100_000])
def test_copies_are_folded_before_ordering(spark, chunk):
    """Without a tie, readings of an instant are ordered by value and copies are exact."""
    rnd = random.Random(3)
    data = [(1, "a", at(rnd.randint(0, 30)), rnd.choice([None, 1.0, 1.5, 2.0]), i) for i in range(200)] + [(1, "a", at(5), 1.0, i) for i in range(200, 500)]
    df = spark.createDataFrame(data, SCHEMA)
    order = {}
    for r in sorted(data, key=lambda r: (r[2], r[3] is None, r[3] or 0)):
        order.setdefault((r[0], r[1]), []).append(r)
    assert profile_of(s.signal_profile(df, chunk_seconds=chunk)) == brute_profile(order)


@pytest.mark.parametrize("chunk", [1, 97, 100_000])
@pytest.mark.parametrize("tie", ["tie", None])
def test_wide_equals_long(spark, chunk, tie):
    rnd = random.Random(5)
    sensors = [f"s{i}" for i in range(6)]
    data = [(rnd.choice([1, 1, 2]), at(2 * i), i, *[rnd.choice([None, 1.0, 1.0, 2.0]) for _ in sensors]) for i in range(200)]
    df = spark.createDataFrame(data, "case_id long, time timestamp_ntz, tie long, " + ", ".join(f"{x} double" for x in sensors))
    grouped = {}
    for r in data:
        for x, v in zip(sensors, r[3:]):
            grouped.setdefault((r[0], x), []).append((r[0], x, r[1], v, r[2]))
    assert profile_of(s.signal_profile_wide(df, tie=tie, sensors=sensors, chunk_seconds=chunk)) == brute_profile(grouped)


def test_wide_copies(spark):
    one = (1, at(0), 1.0, None)
    df = spark.createDataFrame([one] * 5 + [(1, at(1), 1.0, 2.0)] * 3, "case_id long, time timestamp_ntz, a double, b double")
    assert profile_of(s.signal_profile_wide(df)) == {(1, "a"): (8, 2.0, 7, 0), (1, "b"): (3, 1.0, 2, 0)}


def test_a_hundred_sensors_in_one_shuffle(spark, tmp_path):
    names = [f"track_{i}" for i in range(120)]
    spark.range(200).select(
        (F.col("id") % 3).alias("case_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("time"),
        *[((F.col("id") * (i + 1)) % 7).cast("double").alias(n) for i, n in enumerate(names)]).write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w"))
    profile = s.signal_profile_wide(wide, tie="time")
    assert profile.count() == 360
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # wide rows once, then chunk summaries


def test_activity(spark):
    df = spark.createDataFrame([(1, "one", at(0), 1.0, 1), (1, "two", at(0), 1.0, 2), (1, "two", at(9), 1.0, 3), (1, "none", at(0), None, 4),
                                (None, "x", at(0), 1.0, 5)], SCHEMA)
    got = {r.sensor_name: (r.uptime_percentage, r.null_rate_percentage) for r in s.sensor_activity(df).collect()}
    assert got == {"one": (100.0, 0.0), "two": (20.0, 80.0)}


def test_anomaly_edges(spark):
    values = [1.0, 1.0, None, 1.0, 1.3, 0.0, 5.0]
    df = spark.createDataFrame([(1, "a", at(i), v, i) for i, v in enumerate(values)], SCHEMA)
    r = s.signal_anomalies(df, tie="tie").first()
    assert (r.frozen_signal_count, r.noise_spikes_count) == (1, 3)


def test_uptime(spark):
    df = spark.createDataFrame(
        [(1, at(0), "a", 1.0), (1, at(60), "a", 1.0), (1, at(200), "a", 1.0), (1, at(100), "b", 1.0), (2, at(0), "a", 1.0), (None, at(0), "a", 1.0)],
        "surgery_id long, ts timestamp_ntz, sensor_id string, value double")
    got = {(r.surgery_id, r.sensor_id): (r.uptime_seconds, r.surgery_seconds, r.uptime_rate) for r in s.sensor_uptime(df).collect()}
    assert got == {(1, "a"): (60.0, 200.0, 0.3), (1, "b"): (0.0, 200.0, 0.0), (2, "a"): (0.0, None, None)}


def test_windows(spark):
    df = spark.createDataFrame(
        [(1, at(0), "a", 1.0), (1, at(299), "a", 3.0), (1, at(300), "a", 5.0)], "surgery_id long, ts timestamp_ntz, sensor_id string, value double")
    got = rows(s.view_window(df).select("window_start", "avg_value", "stddev_value", "n_samples"))
    assert got == [(at(0), 2.0, pytest.approx(2 ** 0.5), 2), (at(300), 5.0, None, 1)]
    critical = rows(s.view_window(df, low=2.0, high=4.0).select("window_start", "n_critical", "pct_critical"))
    assert critical == [(at(0), 1, 0.5), (at(300), 1, 1.0)]
    assert "n_critical" not in s.view_window(df).columns


def test_columns_are_found_by_name(spark):
    df = spark.createDataFrame([(1, at(0), "a", 1.0)], "case_id long, time timestamp_ntz, sensor_name string, measurement double")
    assert s.view_window(df).columns[:3] == ["case_id", "sensor_name", "window_start"]
    assert s.sensor_uptime(df).count() == 1
    with pytest.raises(ValueError, match="sensor column"):
        s.sensor_uptime(df.drop("sensor_name"))


def graded(spark, **values):
    base = dict(case_id=1, sensor_name="art_mbp", null_rate_percentage=0.0, frozen_signal_count=0, noise_spikes_count=0, hardware_failures=0,
                sensor_active_seconds=100.0, valid_readings=100)
    base.update(values)
    return s.health_grade(spark.createDataFrame([base])).first().health_grade


@pytest.mark.parametrize("values, grade", [
    ({}, fv.GRADE_EXCELLENT),
    ({"null_rate_percentage": 2.0}, fv.GRADE_EXCELLENT),
    ({"null_rate_percentage": 2.1}, fv.GRADE_ACCEPTABLE),
    ({"null_rate_percentage": 10.5}, fv.GRADE_ACCEPTABLE),
    ({"null_rate_percentage": 10.6}, fv.GRADE_DEGRADED),
    ({"null_rate_percentage": 15.0}, fv.GRADE_DEGRADED),
    ({"null_rate_percentage": 15.1}, fv.GRADE_CRITICAL),
    ({"hardware_failures": 1, "sensor_active_seconds": 1000.0}, fv.GRADE_ACCEPTABLE),
    ({"hardware_failures": 2}, fv.GRADE_DEGRADED),
    ({"hardware_failures": 6}, fv.GRADE_CRITICAL),
    ({"frozen_signal_count": 11}, fv.GRADE_DEGRADED),
    ({"noise_spikes_count": 6}, fv.GRADE_DEGRADED),
    ({"noise_spikes_count": 60, "sensor_name": "ECG_II"}, fv.GRADE_EXCELLENT),
    ({"null_rate_percentage": 60.0, "sensor_name": "nibp_sbp"}, fv.GRADE_ACCEPTABLE),
    # matches low frequency (co2) and setting (rate): the later rule wins
    ({"null_rate_percentage": 60.0, "sensor_name": "bis_rate_co2"}, fv.GRADE_CRITICAL),
    ({"frozen_signal_count": 90, "sensor_name": "bis_rate_co2"}, fv.GRADE_EXCELLENT),
])
def test_grades(spark, values, grade):
    assert graded(spark, **values) == grade


def test_failures(spark):
    log = spark.createDataFrame(
        [(1, at(0), "a", 1.0, "OUT OF BOUNDS (min: 0)"), (1, at(0), "a", 1.0, "Signal loss"), (1, at(0), "a", 1.0, None), (None, at(0), "a", 1.0, "Signal loss")],
        EMPTY_LOG)
    assert rows(s.real_failures(log)) == [(1, "a", 2)]
    got = rows(s.hardware_failures(log, sensors_metadata(spark)).select("equipment_brand", "error_reason", "failure_count"))
    assert got == [("A", "OUT OF BOUNDS (min: 0)", 1), ("A", "Signal loss", 1)]


def test_health(spark):
    wide = spark.createDataFrame([(1, at(i), 60.0 + i * 0.1, None if i else 5.0) for i in range(20)],
                                 "case_id long, time timestamp_ntz, solar8000_hr double, bis_sqi double")
    log = spark.createDataFrame([(1, at(0), "solar8000_hr", 0.0, "Signal loss")] * 2, EMPTY_LOG)
    got = {r.sensor_name: r for r in s.sensor_health(wide, log, sensors_metadata(spark)).collect()}
    assert got["solar8000_hr"].health_grade == fv.GRADE_CRITICAL and got["solar8000_hr"].hardware_failures == 2
    assert got["bis_sqi"].health_grade == fv.GRADE_EXCELLENT and got["bis_sqi"].equipment_brand == "BIS"
    assert s.sensor_health(wide, log, sensors_metadata(spark)).columns == s.HEALTH_COLUMNS


def test_drift(spark):
    assert len(s.drift_pairs()) == 31
    wide = spark.createDataFrame([(1, at(0), 60.0, 62.0, None), (1, at(1), None, 1.0, 3.0), (1, at(2), float("nan"), 1.0, None)],
                                 "case_id long, time timestamp_ntz, solar8000_hr double, cardioq_hr double, solar8000_pleth_hr double")
    got = rows(s.cross_sensor_drift(wide).select("sensor_id_1", "sensor_id_2", "drift_value"))
    assert got == [("solar8000_hr", "cardioq_hr", 2.0), ("solar8000_pleth_hr", "cardioq_hr", 2.0)]
    assert "Exchange" not in s.cross_sensor_drift(wide)._jdf.queryExecution().executedPlan().toString()
    assert s.cross_sensor_drift(wide.select("case_id", "time", "solar8000_hr")).count() == 0


def test_reshape(spark):
    wide = spark.createDataFrame([(1, at(0), 1.0, None, "x"), (2, None, 2.0, 3.0, "y")], "case_id long, time timestamp_ntz, a double, `b c` double, source_system string")
    long = to_long(wide, ["case_id", "time", "ingest_time"])
    assert long.count() == 4 and long.columns == ["case_id", "time", "sensor_name", "reading"]
    assert rows(to_long_clean(wide)) == [(1, at(0), "a", 1.0)]
    with pytest.raises(ValueError, match="no case column|no time column|among"):
        to_long_clean(wide.drop("time"))
    with pytest.raises(ValueError, match="nothing"):
        require_rows(to_long_clean(wide).where("value > 10"), "nothing")


def test_keep_active(spark):
    df = spark.createDataFrame(skewed(), SCHEMA)
    active = df.where("case_id = 1").select(*KEYS)
    assert keep_active(df, active, KEYS).count() == df.where("case_id = 1").count()


def test_health_rules_from_a_file(spark, tmp_path):
    import json

    from perispark import fixed_values as fv

    path = tmp_path / "rules.json"
    path.write_text(json.dumps(fv.HEALTH_RULES), encoding="utf-8")
    rules = s.load_health_rules(str(path))
    rows = spark.createDataFrame([("c", "nibp_sbp", 50.0, 0, 0, 0, 10.0, 10), ("c", "x_hr", 50.0, 0, 0, 0, 10.0, 10)],
                                 "case_id string, sensor_name string, null_rate_percentage double, frozen_signal_count int, noise_spikes_count int, hardware_failures int, sensor_active_seconds double, valid_readings int")
    got = {r.sensor_name: r.health_grade for r in s.health_grade(rows, rules).collect()}
    assert got == {"nibp_sbp": fv.GRADE_ACCEPTABLE, "x_hr": fv.GRADE_CRITICAL}


def test_text_sensors_are_graded(spark):
    wide = spark.createDataFrame([("c", i, str(i) if i % 5 else "bad") for i in range(20)], "case_id string, sec int, bis_bis string")
    wide = wide.select("case_id", F.timestamp_seconds("sec").alias("time"), "bis_bis")
    profile = s.signal_profile_wide(wide, tie="time").collect()
    assert [(r.sensor_name, r.valid_readings) for r in profile] == [("bis_bis", 16)]
