import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions import columns as c
from perispark.sources.dims import lab_limits, sensors_metadata


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Case_ID", "Solar8000/ART MBP"])
    assert c.normalize_columns(df, "sensor").columns == ["case_id", "solar8000_art_mbp"]
    assert c.normalize_name("  Caseid ", "lower") == "caseid"
    assert c.normalize_name(" Sepal Length", "snake") == "sepal_length"
    with pytest.raises(ValueError, match="fall together"):
        c.normalize_columns(spark.createDataFrame([(1, 2)], ["A", " a"]), "lower")


def test_numbers(spark):
    texts = ["5", " 5 ", "abc", "", "1d", "1f", "1e3", "NaN", None, "-.5", "5.", "inf", "0x10", "1_000"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(c.to_numeric("t")).collect()]
    assert got == [5.0, 5.0, None, None, None, None, 1000.0, None, None, -0.5, 5.0, math.inf, None, None]


def test_nan_is_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in c.clean_nans(df).collect()] == [1.0, None, None]


def test_epoch(spark):
    df = spark.createDataFrame([(0.0,), (1.25,), (None,), (1700000000.123456,)], "t double")
    got = [r[0] for r in df.select(c.epoch_to_ts("t")).collect()]
    assert got[:3] == [dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 0, 0, 1, 250000), None]
    assert abs((got[3] - dt.datetime(2023, 11, 14, 22, 13, 20, 123456)).total_seconds()) < 2e-6


def test_brand_fallback(spark):
    df = spark.createDataFrame([("bis_sqi",), ("cardioq_x",), ("BIS_a",), ("Primus_b_c",), ("plain",)], "s string")
    assert [r[0] for r in df.select(c.brand_from_name("s")).collect()] == ["BIS", "Cardioq", "BIS", "Primus", "Plain"]


def test_labels(spark):
    df = spark.createDataFrame([("General Surgery", "HB"), ("Dentistry", "xyz"), (None, None)], "d string, l string")
    got = df.select(c.map_labels("d", fv.DEPARTMENT_LABELS).alias("d"), c.map_labels("l", fv.LAB_LABELS, "upper").alias("l")).collect()
    assert got[0].d == "Cirurgia Geral" and got[0].l.startswith("Hemoglobina")
    assert got[1].d == "Dentistry" and got[1].l == "XYZ"
    assert got[2].d is None and got[2].l is None


def test_text_and_phase(spark):
    df = spark.createDataFrame([(" f ", 0.0), (None, -1.0)], "s string, d double")
    assert [tuple(r) for r in df.select(c.std_text("s"), c.surgery_phase("d")).collect()] == [("F", "POS_OP"), (None, "PRE_OP")]


def test_opt_filter(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    assert c.opt_filter(df, "x", "Todos").count() == 3
    assert c.opt_filter(df, "x", None).count() == 3
    assert c.opt_filter(df, "x", "a").count() == 1
    assert c.opt_filter(df, "x", ["a", "b"]).count() == 2


def test_pick_column(spark):
    df = spark.createDataFrame([(1,)], ["case_id"])
    assert c.pick_column(df, ["surgery_id", "case_id"]) == "case_id"
    with pytest.raises(ValueError):
        c.pick_column(df, ["ts"], "time column")


def test_dimensions(spark):
    sensors = sensors_metadata(spark)
    assert sensors.count() == 30
    assert sensors.select("parameter_measured").distinct().count() == 13
    assert sensors.where("sensor_id = 'snuadc_cvp'").first().equipment_brand == "SNUADC"
    assert lab_limits(spark).where(F.col("min_normal") < F.col("max_normal")).count() == 5
