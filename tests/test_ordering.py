import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from perispark.operators import ordering as o
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def skewed(n=600, seed=1):
    """Random readings; a third belongs to one sensor, and instants repeat."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        case, sensor = (1, "hot") if i % 3 == 0 else (rnd.randint(1, 5), rnd.choice(["a", "b"]))
        out.append((case, sensor, at(rnd.randint(0, 4000)), rnd.choice([None, 1.0, 1.0, 1.1, 2.0, 0.0]), i))
    return out


SCHEMA = "case_id long, sensor_name string, time timestamp_ntz, value double, tie long"
KEYS = ["case_id", "sensor_name"]


def groups(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[2], r[4])):
        out.setdefault((r[0], r[1]), []).append(r)
    return out


def test_keep_last(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 2, "d"), (2, 1, None)], "k int, o int, v string")
    assert rows(o.dedupe_keep_last(df, ["k"], ["o"])) == [(None, 2, "d"), (1, 2, "b"), (2, 1, None)]


def test_most_recent_is_one_per_group(spark):
    data = [(1, "x", 1.0, 1), (1, "x", 2.0, 2), (1, "x", 2.0, 3), (1, None, 0.0, 4), (1, None, 1.0, 5), (None, "x", 5.0, 6)]
    df = spark.createDataFrame(data, "k int, n string, dt double, tie int")
    flagged = o.flag_most_recent(df, ["k", "n"], ["dt", "tie"])
    assert sorted(r.tie for r in flagged.where("is_most_recent").collect()) == [3, 5, 6]
    assert flagged.count() == len(data)


def test_unread_flag_costs_no_join(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "k int, o int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = o.flag_most_recent(df, ["k"], ["o"]).groupBy("k").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("gap, per_chunk", [(0, 10_000), (5, 1), (5, 7), (60, 3), (60, 10_000), (0.5, 100)])
def test_sessions(spark, gap, per_chunk):
    data = skewed()
    df = spark.createDataFrame(data, SCHEMA)
    expected, spans = {}, {}
    for key, group in groups(data).items():
        seg, before = 0, None
        for r in group:
            if before is None or (r[2] - before).total_seconds() > gap:
                seg += 1
            before = r[2]
            expected[r[4]] = seg
            lo, hi = spans.get((*key, seg), (r[2], r[2]))
            spans[(*key, seg)] = (min(lo, r[2]), max(hi, r[2]))
    assert {r.tie: r.seg_id for r in o.gap_segments(df, KEYS, "time", gap, per_chunk).collect()} == expected
    got = {(r.case_id, r.sensor_name, r.seg_id): (r.seg_start, r.seg_end) for r in o.segment_spans(df, KEYS, "time", gap, per_chunk).collect()}
    assert got == spans
    on = {}
    for (case, sensor, _), (lo, hi) in spans.items():
        on[(case, sensor)] = on.get((case, sensor), 0) + (hi - lo).total_seconds()
    seconds = o.session_seconds(df, KEYS, "time", gap, per_chunk).collect()
    assert {(r.case_id, r.sensor_name): r.on_seconds for r in seconds} == on


def test_gap_at_the_limit_stays_in_session(spark):
    df = spark.createDataFrame([(1, "a", at(0), 1.0, 1), (1, "a", at(60), 1.0, 2), (1, "a", at(120.000001), 1.0, 3)], SCHEMA)
    assert {r.tie: r.seg_id for r in o.gap_segments(df, KEYS, "time", 60).collect()} == {1: 1, 2: 1, 3: 2}


@pytest.mark.parametrize("chunk", [50, 1000, 100_000])
def test_positions(spark, chunk):
    data = skewed()
    df = spark.createDataFrame(data, SCHEMA)
    placed = o.row_positions(df, KEYS, ["time", "tie"], o.time_chunk("time", chunk), "pos", "total")
    expected = {r[4]: (i, len(g)) for g in groups(data).values() for i, r in enumerate(g)}
    assert {r.tie: (r.pos, r.total) for r in placed.collect()} == expected


@pytest.mark.parametrize("block", [7, 50, 100_000])
def test_smoothing_across_blocks(spark, block):
    data = skewed(300)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.tie: r for r in o.signal_smoothing(df, KEYS, "time", "value", "tie", 5, 300, block).collect()}
    assert len(got) == len(data)
    for group in groups(data).values():
        for i, r in enumerate(group):
            window = [x[3] for x in group[max(0, i - 4): i + 1] if x[3] is not None]
            row = got[r[4]]
            if not window:
                assert row.moving_avg is None
                continue
            mean = sum(window) / len(window)
            assert row.moving_avg == pytest.approx(mean)
            if len(window) > 1:
                assert row.moving_std == pytest.approx((sum((x - mean) ** 2 for x in window) / (len(window) - 1)) ** 0.5)
            else:
                assert row.moving_std is None


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_running_totals(spark, descending, buckets):
    values = {float(v): v % 5 + 1 for v in range(-50, 200)}
    df = spark.createDataFrame(list(values.items()), "v double, n long").repartition(5)
    got = {r.v: r.cum_n for r in o.running_totals(df, "v", ["n"], descending, buckets).collect()}
    total, expected = 0, {}
    for v in sorted(values, reverse=descending):
        total += values[v]
        expected[v] = total
    assert got == expected


def test_sample_and_watermark(spark):
    df = spark.range(1000).toDF("k")
    a, b = o.sample_n(df, "k", 100), o.sample_n(df.repartition(7), "k", 100)
    assert rows(a) == rows(b) and a.count() == 100
    assert o.sample_n(df, "k", 5000).count() == 1000
    assert o.after_watermark(df, df.where("k < 990"), "k").count() == 10
    assert o.after_watermark(df, df.where("k < 0"), "k").count() == 1000


def test_top_k(spark):
    df = spark.range(100).toDF("k")
    assert [r.k for r in o.top_k(df, [F.desc("k")], 3).collect()] == [99, 98, 97]


def test_chunks_of_sessions_are_hours_whatever_the_gap(spark):
    df = spark.range(5000).select(F.lit("a").alias("k"), F.timestamp_micros(F.col("id") * 100_000).alias("t"))
    chunks = o._gap_cells(df, ["k"], "t", 0, o.CELLS_PER_CHUNK).select("_chunk").distinct().count()
    assert chunks == 1  # 500 seconds of readings
    assert o.gap_segments(df, ["k"], "t", 0).select("seg_id").distinct().count() == 5000
