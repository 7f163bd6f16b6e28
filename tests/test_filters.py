import datetime as dt

from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.operators.filters import BoundsRule, TimeRule, bounds_filter, run_filters, split_valid, time_filter
from perispark.plans.labs import labs_split
from perispark.plans.patients import patients_split
from perispark.plans.vitals import vitals_clean_quarantine

T0 = dt.datetime(2024, 1, 1)


def test_bounds_are_bad_themselves(spark):
    values = [0.0, 0.001, 50.0, 99.9, 100.0, None, float("nan"), -5.0]
    df = spark.createDataFrame([(i, T0, v) for i, v in enumerate(values)], "case_id long, time timestamp_ntz, x double")
    clean, log = bounds_filter(df, ["x", "absent"], 0, 100)
    kept = {r.case_id: r.x for r in clean.collect()}
    assert {k for k, v in kept.items() if v is not None and v == v} == {1, 2, 3}
    assert clean.count() == len(values)
    found = log.collect()
    assert {r.case_id for r in found} == {0, 4, 7}
    assert {r.error_reason for r in found} == {"Out of bounds (min: 0, max: 100)"}
    assert log.columns == ["case_id", "time", "sensor_name", "original_value", "error_reason"]


def test_time_rule(spark):
    limit = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, None), (2, limit), (3, limit + dt.timedelta(seconds=1))], "case_id long, time timestamp_ntz")
    clean, log = time_filter(df, limit=limit, limit_text="L")
    assert {r.case_id: r.time for r in clean.collect()} == {1: None, 2: limit, 3: None}
    assert {r.case_id: r.error_reason for r in log.collect()} == {1: "Time is Null", 3: "Future Date (> L)"}
    only_null = time_filter(df, checks=("null",), limit=limit)[1]
    assert [r.case_id for r in only_null.collect()] == [1]


def test_time_rule_on_epoch_seconds(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, float("nan"))], "case_id long, time double")
    log = time_filter(df, limit=15.0)[1].collect()
    assert {r.case_id: r.error_reason for r in log} == {2: "Future Date (> 15.0)", 3: "Time is Null"}


def test_chain_shows_later_rules_what_earlier_ones_left(spark):
    df = spark.createDataFrame([(1, T0, -1.0), (2, T0, 5.0), (3, T0, 50.0)], "case_id long, time timestamp_ntz, x double")
    clean, log = run_filters(df, [BoundsRule(["x"], 0), BoundsRule(["x"], None, 10)])
    assert {(r.case_id, r.error_reason) for r in log.collect()} == {
        (1, "Out of bounds (min: 0, max: None)"), (3, "Out of bounds (min: None, max: 10)")}
    assert {r.case_id: r.x for r in clean.collect()} == {1: None, 2: 5.0, 3: None}


def test_plug_in_rule(spark):
    df = spark.createDataFrame([(1, T0, -1.0), (2, T0, 5.0)], "case_id long, time timestamp_ntz, x double")

    def drop_big(frame):
        bad = frame.where("x > 4").select("case_id", "time", F.lit("x").alias("sensor_name"), F.col("x").alias("original_value"), F.lit("big").alias("error_reason"))
        return frame.where("x <= 4 OR x IS NULL"), bad

    clean, log = run_filters(df, [BoundsRule(["x"], 0), drop_big])
    assert [r.case_id for r in clean.collect()] == [1]
    assert {(r.case_id, r.error_reason) for r in log.collect()} == {(1, "Out of bounds (min: 0, max: None)"), (2, "big")}


def test_no_rules(spark):
    df = spark.createDataFrame([(1, T0)], "case_id long, time timestamp_ntz")
    clean, log = run_filters(df, [])
    assert clean.count() == 1 and log.count() == 0
    assert log.columns[-1] == "error_reason"


def test_vitals_pipeline(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 60.0, 99.0, -5.0, "x"), (1, 1.0, 0.0, 100.001, -4.9, None), (1, None, float("nan"), 101.0, None, None)],
        "Case_ID long, Time double, `Solar8000/HR` double, `Solar8000/PLETH_SPO2` double, `Primus/AWP` double, Note string")
    clean, log = vitals_clean_quarantine(df)
    assert clean.columns == ["case_id", "time", "solar8000_hr", "solar8000_pleth_spo2", "primus_awp", "note"]
    assert clean.count() == 3
    assert sorted((r.sensor_name, r.original_value) for r in log.collect()) == [
        ("primus_awp", -5.0), ("solar8000_hr", 0.0), ("solar8000_pleth_spo2", 100.001), ("solar8000_pleth_spo2", 101.0)]
    assert log.where("sensor_name = 'time'").count() == 0
    assert {r.error_reason for r in log.where("sensor_name = 'primus_awp'").collect()} == {"Out of bounds (min: -5.0, max: None)"}


def test_cleaning_needs_no_shuffle(spark):
    df = spark.createDataFrame([(1, T0, -1.0)], "case_id long, time timestamp_ntz, solar8000_hr double")
    for frame in run_filters(df, [TimeRule(), BoundsRule(["solar8000_hr"], 0)]):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_labs_split(spark):
    df = spark.createDataFrame(
        [(1, "0", "hb", "0", 1), (1, "-1", "hb", "12.5", 2), (1, "0", "hb", "7", 3), (None, "1", "hb", "3", 4), (2, "x", "hb", "3", 5),
         (2, "1", "hb", "-1", 6), (2, "1", "hb", None, 7)], " CaseID long, DT string, Name string, Result string, row int")
    good, bad = labs_split(df, tie=["row"])
    assert {(r.row, r.surgery_phase, r.is_most_recent) for r in good.collect()} == {(1, "POS_OP", False), (2, "PRE_OP", True), (3, "POS_OP", True)}
    assert {r.row for r in bad.collect()} == {4, 5, 6, 7}
    assert {r.error_reason for r in bad.collect()} == {fv.LAB_REASON}
    assert good.count() + bad.count() == df.count()


def test_patients_split(spark):
    rows = [(1, 0.0, None, None, "m"), (2, 120.0, 40.0, 2.0, " f"), (3, 121.0, 100.0, 50.0, "m"), (4, None, 100.0, 50.0, "m"), (5, 50.0, 251.0, 50.0, None),
            (6, 50.0, 250.0, 400.0, None), (7, 50.0, 100.0, 1.0, "m"), (8, 50.0, 100.0, 50.0, "x"), (8, 51.0, 100.0, 50.0, "y"), (None, 50.0, 100.0, 50.0, "m"),
            (None, 60.0, 100.0, 50.0, "m")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "caseid long, age double, height double, weight double, sex string, row int")
    demo, surgery, bad = patients_split(df, order=["row"])
    assert {(r.caseid, r.age, r.sex) for r in demo.collect()} == {(1, 0.0, "M"), (2, 120.0, "F"), (6, 50.0, None), (8, 51.0, "Y")}
    assert surgery.columns == ["caseid"]
    assert sorted(r.row for r in bad.collect()) == [2, 3, 4, 6, 10]
    assert {r.error_reason for r in bad.collect()} == {fv.PATIENT_REASON}


def test_split_counts_unknown_as_bad(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    good, bad = split_valid(df, F.col("x") > 0, "no")
    assert good.count() == 1 and bad.count() == 2
