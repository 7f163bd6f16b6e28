"""Tables in buckets of their keys, lossless widening, lag objectives, and stored runs and models."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perispark.contracts import CONTRACTS
from perispark.operators import quality as q
from perispark.operators import upsert as up
from perispark.operators.ordering import exact_quantiles
from perispark.sources.lake import Lake
from tests.conftest import rows
from tests.test_tables import BATCH, CURRENT, PATIENTS

WIDE = "caseid long, subjectid long, age double, sex string, source_system string"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def people(spark, n=2000, age=1.0):
    return spark.range(n).select("id", (F.col("id") + 7).alias("subject"), (F.col("id") * age).alias("age"), F.lit("s").alias("source_system"))


def files(lake, version):
    root = os.path.join(lake.root, "bronze", "people", f"v={version}", "b=1")
    return {d for d in os.listdir(root) if d.startswith("_bucket=")} if os.path.isdir(root) else set()


KEYS = ["id", "subject"]


def test_a_small_batch_touches_its_buckets_alone(spark, lake):
    assert lake.upsert(people(spark), "bronze", "people", KEYS, buckets=64)
    assert len(files(lake, 1)) == 64
    batch = people(spark, age=2.0).where("id % 200 = 3")
    assert batch.count() == 10
    part, buckets = lake.touched(batch, "bronze", "people")
    read = {os.path.dirname(f) for f in part.inputFiles()}
    assert len(buckets) <= 10 and len(read) == len(buckets)
    assert lake.upsert(batch, "bronze", "people", KEYS)
    assert len(files(lake, 2)) == len(buckets)
    layout = lake.layout("bronze", "people")
    assert len(layout["at"]) == 64 and sum(at.startswith("v=2/") for at in layout["at"].values()) == len(buckets)
    assert rows(lake.read("bronze", "people")) == rows(up.upsert(people(spark), batch, KEYS))


def test_same_rows_as_a_plain_table(spark, lake, tmp_path):
    plain = Lake(spark, str(tmp_path / "plain"))
    rng, n = random.Random(4), 400
    base = people(spark, n)
    for where, options in ((lake, {"buckets": 8}), (plain, {})):
        where.upsert(base, "bronze", "people", KEYS, **options)
    for step in range(4):
        ids = [rng.randrange(n + 100) for _ in range(30)]
        batch = spark.createDataFrame([(i, i + 7, float(i + step), f"b{step}") for i in sorted(set(ids))], base.schema)
        assert rows(lake.change_log(batch, "bronze", "people", KEYS)) == rows(plain.change_log(batch, "bronze", "people", KEYS))
        assert lake.upsert(batch, "bronze", "people", KEYS) == plain.upsert(batch, "bronze", "people", KEYS)
        assert rows(lake.read("bronze", "people")) == rows(plain.read("bronze", "people"))


def test_an_identical_batch_and_null_keys(spark, lake):
    current, batch = spark.createDataFrame(CURRENT, PATIENTS), spark.createDataFrame(BATCH, PATIENTS)
    assert lake.upsert(current, "bronze", "patients", buckets=4)
    assert not lake.upsert(current.withColumn("source_system", F.lit("later")), "bronze", "patients")
    assert lake.current("bronze", "patients")[0] == 1
    assert lake.upsert(batch, "bronze", "patients")
    assert rows(lake.read("bronze", "patients")) == rows(up.upsert(current, batch))
    with pytest.raises(ValueError, match="repeats"):
        lake.upsert(batch.union(batch), "bronze", "patients")
    with pytest.raises(ValueError, match="keyed by"):
        lake.upsert(batch, "bronze", "patients", keys=["caseid"])
    with pytest.raises(ValueError, match="by upsert"):
        lake.write(batch, "bronze", "patients", mode="append")


def test_new_columns_and_wider_types(spark, lake):
    lake.upsert(people(spark, 100), "bronze", "people", KEYS, buckets=8)
    more = people(spark, 3).withColumn("note", F.lit("n"))
    assert lake.upsert(more, "bronze", "people", KEYS)
    read = lake.read("bronze", "people")
    assert read.columns[-1] == "note" and read.where("note = 'n'").count() == 3 and read.count() == 100
    shorter = people(spark, 5, 3.0).select(F.col("id").cast("int"), F.col("subject").cast("short"), F.col("age").cast("float"), "source_system")
    assert lake.touched(shorter, "bronze", "people") is not None
    assert lake.upsert(shorter, "bronze", "people", KEYS)
    assert lake.read("bronze", "people").where("age = 3 * id and id < 5 and note is null").count() == 5 - 3
    narrow = Lake(spark, lake.root + "-narrow")
    narrow.upsert(people(spark, 50).withColumn("age", F.col("age").cast("int")), "bronze", "people", KEYS, buckets=4)
    wide = people(spark, 2, 0.5)
    assert narrow.touched(wide, "bronze", "people") is None  # the untouched files hold whole numbers: all are rewritten
    assert narrow.upsert(wide, "bronze", "people", KEYS)
    assert narrow.read("bronze", "people").schema["age"].dataType == T.DoubleType()
    assert narrow.read("bronze", "people").agg(F.sum("age")).first()[0] == sum(range(50)) - 0.5


def test_a_plain_table_becomes_keyed(spark, lake):
    lake.upsert(people(spark, 60), "bronze", "people", KEYS)
    assert lake.layout("bronze", "people") is None
    assert lake.upsert(people(spark, 10, 2.0), "bronze", "people", KEYS, buckets=8)
    assert lake.layout("bronze", "people")["buckets"] == 8
    assert rows(lake.read("bronze", "people")) == rows(up.upsert(people(spark, 60), people(spark, 10, 2.0), KEYS))


def test_a_failed_upsert_leaves_the_table(spark, lake):
    lake.upsert(people(spark, 60), "bronze", "people", KEYS, buckets=8)
    bad = people(spark, 5, 2.0).withColumn("age", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("age")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        lake.upsert(bad, "bronze", "people", KEYS)
    assert rows(lake.read("bronze", "people")) == rows(people(spark, 60))


# ---- widening ----
def test_no_digit_is_lost(spark):
    whole = spark.createDataFrame([(1, 2 ** 53)], "caseid long, x long")
    half = spark.createDataFrame([(2, 0.5)], "caseid long, x double")
    assert rows(up.upsert(whole, half, ["caseid"])) == [(1, float(2 ** 53)), (2, 0.5)]
    for much in (2 ** 53 + 1, -(2 ** 53) - 1, 2 ** 63 - 1):
        with pytest.raises(Exception, match="no double holds"):
            up.upsert(spark.createDataFrame([(1, much)], "caseid long, x long"), half, ["caseid"]).collect()
    fine = spark.createDataFrame([(1, Decimal("0.10"))], "caseid long, x decimal(10,2)")
    assert rows(up.upsert(fine, half, ["caseid"])) == [(1, 0.1), (2, 0.5)]
    with pytest.raises(Exception, match="no double holds"):
        up.upsert(spark.createDataFrame([(1, Decimal("9007199254740993.01"))], "caseid long, x decimal(20,2)"), half, ["caseid"]).collect()
    with pytest.raises(TypeError, match="no decimal"):
        up.common_type("x", T.DecimalType(38, 0), T.DecimalType(20, 10))
    assert up.common_type("x", T.DecimalType(20, 0), T.DecimalType(20, 10)) == T.DecimalType(30, 10)


# ---- objectives ----
def quantile(values, rank):
    values, place = sorted(values), rank * (len(values) - 1)
    low = int(place)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)


def test_exact_quantiles(spark):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.0, rng.random()])) for _ in range(500)] + [("lone", 4.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    ranks = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r.g, r["rank"]): (r.value, r.n) for r in exact_quantiles(df, "v", ranks, ["g"]).collect()}
    groups = {g: [v for h, v in data if h == g and v is not None] for g in ("a", "b", None, "lone")}
    assert got == {(g, r): (pytest.approx(quantile(v, r)), len(v)) for g, v in groups.items() for r in ranks}
    everything = [v for _, v in data if v is not None]
    assert {r["rank"]: r.value for r in exact_quantiles(df, "v", ranks).collect()} == {r: pytest.approx(quantile(everything, r)) for r in ranks}
    assert exact_quantiles(df.where("false"), "v", ranks).count() == 0
    with pytest.raises(ValueError, match="ranks"):
        exact_quantiles(df, "v", [95])


def test_objectives_are_read_and_measured(spark):
    doc = {"contract": {"id": "silver.x"}, "quality": {"slo": {
        "freshness": "P95 <= 10m after event generation", "completeness": ">= 99% of valid events", "accuracy": "100% of rows", "note": "updated on demand"}}}
    contract = q.Contract.from_dict(doc)
    assert [(o.name, o.rank, o.limit) for o in contract.objectives] == [("freshness", 0.95, 600.0), ("completeness", None, 99.0), ("accuracy", None, 100.0), ("note", None, None)]
    assert q.Objective("f", "p99.9 < 1.5h").rank == pytest.approx(0.999) and q.Objective("f", "p99.9 < 1.5h").limit == 5400
    lags = spark.createDataFrame([(float(x),) for x in range(101)], "lag_seconds double")
    shares = {"completeness": spark.createDataFrame([(98.9,)], "completeness_pct double"), "accuracy": spark.createDataFrame([(100.0,)], "completeness_pct double")}
    got = {r.objective: (r.measured, r.met) for r in q.slo_report(contract, lags.withColumn("lag_seconds", F.col("lag_seconds") * 10), shares).collect()}
    assert got == {"freshness": (950.0, False), "completeness": (98.9, False), "accuracy": (100.0, True), "note": (None, None)}
    assert {r.objective: r.met for r in q.slo_report(contract, lags).collect()} == {"freshness": True, "completeness": None, "accuracy": None, "note": None}
    assert q.slo_report(q.Contract("empty")).count() == 0
    assert {o.name for o in CONTRACTS["silver.vitals_clean"].objectives} == {"freshness", "completeness", "accuracy"}


def test_lags(spark):
    data = [("2024-01-01 00:00:00", "2024-01-01 00:00:01.5"), ("2024-01-01 00:00:00", None), (None, "2024-01-01 00:00:00"), ("2024-01-01 00:00:02", "2024-01-01 00:00:02")]
    df = spark.createDataFrame(data, "e string, a string").select(F.col("e").cast("timestamp").alias("e"), F.col("a").cast("timestamp").alias("a"))
    assert [(r.lag_seconds, r.n) for r in q.measured_lags(df, "e", "a", [1.0]).collect()] == [(1.5, 2)]


# ---- marker bounds ----
def test_watermark_reads_no_data_file(spark, lake):
    days = spark.range(100).select("id", F.expr("timestamp_ntz '2024-01-01 00:00:00.25' + make_dt_interval(id)").alias("time"))
    assert lake.after(days, "bronze", "feed", "time").count() == 100
    for low, high in ((0, 10), (20, 30), (10, 20)):
        lake.write(days.where(f"id >= {low} AND id < {high}"), "bronze", "feed", mode="append", bounds=["time", "id"])
    lake.write(days.where("id = 5").select("id", F.lit(None).cast("timestamp_ntz").alias("time")), "bronze", "feed", mode="append", bounds=["time", "id"])
    left = lake.after(days, "bronze", "feed", "time")
    assert sorted(r.id for r in left.collect()) == list(range(30, 100))
    assert "Subquery" not in left._jdf.queryExecution().executedPlan().toString() and left.inputFiles() == []
    assert lake.mark("bronze", "feed", "id") == (True, "29")
    some = lake.read_range("bronze", "feed", "id", 12, 15)
    assert len({os.path.dirname(f) for f in some.inputFiles()}) == 1 and sorted(r.id for r in some.collect()) == [12, 13, 14]
    assert lake.read_range("bronze", "feed", "id", 40, 50).count() == 0
    lake.write(days.where("id = 40"), "bronze", "feed", mode="append")  # a batch without bounds is read
    assert lake.mark("bronze", "feed", "id") == (False, None)
    assert sorted(r.id for r in lake.after(days, "bronze", "feed", "id").collect()) == list(range(41, 100))
    assert [r.id for r in lake.read_range("bronze", "feed", "id", 40, 50).collect()] == [40]


# ---- one row by key ----
def test_find_reads_one_bucket(spark, lake):
    lake.upsert(people(spark), "bronze", "people", KEYS, buckets=32)
    got = lake.find("bronze", "people", id=77, subject=84)
    assert len({os.path.dirname(f) for f in got.inputFiles()}) == 1 and [r.age for r in got.collect()] == [77.0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), IsNotNull(subject), EqualTo(id,77), EqualTo(subject,84)]" in plan
    assert lake.find("bronze", "people", id=77, subject=1).count() == 0
    assert [r.subject for r in lake.find("bronze", "people", id=78).collect()] == [85]  # not all keys: every bucket


# ---- batches about to be appended ----
def test_append_report_matches_a_full_check(spark):
    rng = random.Random(8)
    ids = [rng.choice([None, rng.randrange(500)]) for _ in range(300)]
    batch = spark.createDataFrame([(i, rng.choice([None, rng.randrange(60)])) for i in ids], "k int, ref int")
    stored = spark.createDataFrame([(rng.randrange(400, 900),) for _ in range(2000)] + [(None,)], "k long").withColumn("ref", F.lit(1))
    known = spark.range(40).select(F.col("id").alias("id"))
    rules = (q.Rule("is_unique(k)"), q.Rule("ref IN (SELECT id FROM silver.known)", "warning"), q.Rule("no_nulls(k)"))
    got = {r.rule: r.violations for r in q.append_report(batch, stored, q.Contract("c", rules), lambda name: known).collect()}
    there = {r.k for r in stored.select("k").distinct().collect()}
    assert got == {rules[0].text: sum(1 for k in set(ids) if ids.count(k) > 1 or k in there),
                   rules[1].text: sum(1 for r in batch.collect() if r.ref is not None and r.ref >= 40)}
    assert q.append_report(batch, stored, q.Contract("none")).count() == 0


def test_the_filter_keeps_matches_and_drops_most_others(spark):
    batch, stored = spark.range(0, 3000, 3).toDF("k"), spark.range(300_000).toDF("k")
    left = q.may_match(stored, ["k"], q.key_filter(batch, ["k"]))
    assert left.join(batch, "k").count() == 1000 and left.count() < 1200
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "bitmap_construct_agg" in plan
    tiny = q.may_match(stored, ["k"], q.key_filter(batch, ["k"], 4), 4)  # a full filter drops nothing that matches
    assert tiny.join(batch, "k").count() == 1000


# ---- health kept up to date ----
def wide_rows(spark, days, seed=1):
    rng = random.Random(seed)
    data = [(case, f"2024-03-{day:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:{i % 60:02d}", rng.choice([None, 1.0, 1.0, rng.uniform(1, 3)]), rng.choice([None, 5.0, 9.0]))
            for day in days for case in (1, 2, None) for i in range(40)]
    return spark.createDataFrame(data, "case_id long, time string, solar8000_hr double, bis_sqi double").withColumn("time", F.col("time").cast("timestamp_ntz"))


def test_appending_a_day_gives_the_rows_of_a_full_run(spark, lake):
    from perispark.operators import sensors as s
    from perispark.plans import health
    from perispark.sources.dims import sensors_metadata

    quarantine = spark.createDataFrame([], "case_id long, time timestamp_ntz, sensor_name string, original_value double, error_reason string")
    every = None
    for days in ([3, 4, 5], [7], [6], [7]):  # late days and rows that come in twice
        batch = wide_rows(spark, days, sum(days)).persist()
        every = batch if every is None else every.unionByName(batch)
        health.append_clean(lake, batch)
        before = lake.layout(*health.CHUNKS)
        assert health.refresh_chunks(lake, batch) == [f"2024-03-{d:02d}" for d in days]
        at = lake.layout(*health.CHUNKS)["at"]
        assert before is None or {d for d in at if at[d] != before["at"].get(d)} == {f"2024-03-{d:02d}" for d in days}
        want = s.sensor_health(every, quarantine, sensors_metadata(spark))
        assert rows(health.stored_health(lake, quarantine, sensors_metadata(spark))) == rows(want)
    read = lake.read_range(*health.CLEAN, "time", "2024-03-06", "2024-03-07").inputFiles()
    assert len({os.path.dirname(f) for f in read}) == 1  # the batch of that day alone
    assert health.refresh_chunks(lake, batch.where("false")) == []
    with pytest.raises(ValueError, match="whole number"):
        health.refresh_chunks(lake, batch, chunk_seconds=7000)


def test_parts_keep_their_columns(spark, lake):
    df = spark.range(6).select("id", (F.col("id") % 3).cast("string").alias("day"))
    assert lake.write_parts(df, "gold", "t", "day") and not lake.write_parts(df.where("false"), "gold", "t", "day")
    assert lake.write_parts(df.where("day = '1'").withColumn("id", F.col("id") + 100), "gold", "t", "day")
    assert rows(lake.read("gold", "t")) == [(0, "0"), (2, "2"), (3, "0"), (5, "2"), (101, "1"), (104, "1")]
    with pytest.raises(ValueError, match="laid out"):
        lake.write_parts(df.withColumn("x", F.lit(1)), "gold", "t", "day")
