"""Signal quality of sensors: activity, frozen values, spikes, uptime, windows, drift and the health grade."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.fixed_values import AUDIT_COLUMNS, ID_COLUMNS, SENSOR_COLUMNS, TIME_COLUMNS, VALUE_COLUMNS
from perispark.functions.columns import all_present, lenient_double, nan_to_null, pick_column, seconds_between
from perispark.operators.joins import enrich_brand
from perispark.operators.ordering import CHUNK_SECONDS, _order, session_seconds, time_chunk

KEYS = ("case_id", "sensor_name")
HEALTH_COLUMNS = ["case_id", "sensor_name", "equipment_brand", "null_rate_percentage", "frozen_signal_count",
                  "noise_spikes_count", "hardware_failures", "health_grade"]


def _rates(df: DataFrame, sample_seconds: float) -> DataFrame:
    """Uptime and null rate from counts; sensors that never read anything are dropped."""
    expected = (F.col("sensor_active_seconds") - 1) / F.lit(float(sample_seconds)) + 1
    uptime = F.least(F.col("valid_readings") / expected * 100, F.lit(100.0))
    return (
        df.where(F.col("valid_readings") > 0)
        .withColumn("uptime_percentage", uptime)
        .withColumn("null_rate_percentage", F.lit(100.0) - F.col("uptime_percentage"))
    )


def sensor_activity(df: DataFrame, keys: Sequence[str] = KEYS, time: str = "time", value: str = "value",
                    sample_seconds: float = 1) -> DataFrame:
    """Valid readings, active span and uptime of each sensor, in one map-side-combined aggregation."""
    read = df.select(*keys, time, nan_to_null(value).alias("_v")).where(all_present([*keys, "_v"]))
    spans = read.groupBy(*keys).agg(
        F.count("_v").alias("valid_readings"),
        (seconds_between(F.min(time), F.max(time)) + 1).alias("sensor_active_seconds"),
    )
    return _rates(spans, sample_seconds)


def _flags(value: Column, prev: Column, spike: float) -> tuple[Column, Column]:
    """(frozen, spike) of a reading and its predecessor; unknown counts as neither."""
    frozen = F.coalesce(value == prev, F.lit(False))
    change = F.abs(value - prev) / (F.abs(prev) + F.lit(1e-9))
    return frozen, F.coalesce(change > F.lit(spike), F.lit(False))


def _chunk_summaries(cells: DataFrame, keys: Sequence[str], spike: float) -> DataFrame:
    """Reduce (value, prev, n copies, is_first, is_last) cells to one row per key and time chunk."""
    frozen, jump = _flags(F.col("value"), F.col("prev"), spike)
    present = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    read_time = F.when(F.col("value").isNotNull(), F.col("time"))
    return cells.groupBy(*keys, "_chunk").agg(
        F.sum(present).alias("valid"),
        F.min(read_time).alias("first_time"),
        F.max(read_time).alias("last_time"),
        # every copy after the first repeats its predecessor
        F.sum(F.greatest(present - 1, F.lit(0)) + frozen.cast("int")).alias("frozen"),
        F.count_if(jump).alias("spikes"),
        F.max(F.when(F.col("is_first"), F.col("value"))).alias("head"),
        F.max(F.when(F.col("is_last"), F.col("value"))).alias("tail"),
    )


def _across_chunks(chunks: DataFrame, keys: Sequence[str], spike: float) -> DataFrame:
    """Compare the first reading of each chunk with the last of the one before, then add everything up."""
    w = Window.partitionBy(*keys).orderBy(F.col("_chunk").asc_nulls_last())
    frozen, jump = _flags(F.col("head"), F.col("before"), spike)
    return (
        chunks.withColumn("before", F.lag("tail").over(w))
        .groupBy(*keys)
        .agg(
            F.sum("valid").alias("valid_readings"),
            (seconds_between(F.min("first_time"), F.max("last_time")) + 1).alias("sensor_active_seconds"),
            (F.sum("frozen") + F.count_if(frozen)).alias("frozen_signal_count"),
            (F.sum("spikes") + F.count_if(jump)).alias("noise_spikes_count"),
        )
    )


def signal_profile(long: DataFrame, keys: Sequence[str] = KEYS, time: str = "time", value: str = "value",
                   tie: str | None = None, spike: float = 0.20, chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """Activity and anomaly counts per sensor from long readings.

    The readings are put in order by (key, time chunk): a sensor with any number of readings is spread over
    its chunks. The predecessor is the previous reading even when that one is null. ``tie`` orders readings
    of one instant; without it they are ordered by value, and copies are folded into a count before that.
    """
    rows = long.where(all_present(keys)).select(
        *keys, F.col(time).alias("time"), *([F.col(tie).alias("tie")] if tie else []), nan_to_null(value).alias("value")
    )
    rows = rows.withColumn("n", F.lit(1)) if tie else rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("_chunk", time_chunk("time", chunk_seconds))
    w = Window.partitionBy(*keys, "_chunk").orderBy(*_order(["time", "tie" if tie else "value"]))
    cells = rows.select(
        *keys, "_chunk", "time", "value", "n",
        F.lag("value").over(w).alias("prev"),
        F.lag(F.lit(True)).over(w).isNull().alias("is_first"),
        F.lead(F.lit(True)).over(w).isNull().alias("is_last"),
    )
    return _across_chunks(_chunk_summaries(cells, keys, spike), keys, spike)


def signal_profile_wide(wide: DataFrame, case: str = "case_id", time: str = "time", tie: str | None = None,
                        sensors: Sequence[str] | None = None, spike: float = 0.20,
                        chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """:func:`signal_profile` for the wide layout, without multiplying the rows before the shuffle."""
    return profile_of_chunks(chunk_states(wide, case, time, tie, sensors, spike, chunk_seconds), spike)


def profile_of_chunks(chunks: DataFrame, spike: float = 0.20) -> DataFrame:
    """The profile of sensors from the states of their chunks, however these were gathered."""
    return _across_chunks(chunks, KEYS, spike)


def chunk_states(wide: DataFrame, case: str = "case_id", time: str = "time", tie: str | None = None,
                 sensors: Sequence[str] | None = None, spike: float = 0.20, chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """One row per case, sensor and time chunk: counts inside the chunk, its first and last reading.

    States of different chunks add up (:func:`profile_of_chunks`), so only chunks with new rows have to be made anew.

    Wide rows are ordered and lagged once (as one array, whatever the number of sensors); cells are only
    spread out after that, inside the task, and reduced at once to (case, chunk, sensor) summaries. ``tie``
    orders rows of one instant (pass the time itself when it is unique per case); without it rows are ordered
    by their cells, and copies of a row are folded into a count first.
    """
    sensors = list(sensors) if sensors is not None else [c for c in wide.columns if c not in (case, time, tie, *AUDIT_COLUMNS)]
    rows = wide.where(F.col(case).isNotNull()).select(
        F.col(case).alias("case_id"), F.col(time).alias("time"), *([F.col(tie).alias("tie")] if tie else []),
        F.array(*[lenient_double(wide, s) for s in sensors]).alias("cells"),
    )
    rows = rows.withColumn("n", F.lit(1)) if tie else rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("_chunk", time_chunk("time", chunk_seconds))
    w = Window.partitionBy("case_id", "_chunk").orderBy(*_order(["time", "tie" if tie else "cells"]))
    lagged = rows.select(
        "case_id", "_chunk", "time", "cells", "n",
        F.lag("cells").over(w).alias("before"),
        F.lag(F.lit(True)).over(w).isNull().alias("is_first"),
        F.lead(F.lit(True)).over(w).isNull().alias("is_last"),
    )
    before = F.coalesce("before", F.array_repeat(F.lit(None).cast("double"), len(sensors)))
    names = F.array(*[F.lit(s) for s in sensors])
    cells = lagged.select(
        "case_id", "_chunk", "time", "n", "is_first", "is_last",
        F.inline(F.arrays_zip(names.alias("sensor_name"), F.col("cells").alias("value"), before.alias("prev"))),
    )
    # a null cell adds nothing, except that a chunk's last row says what the next chunk is compared with
    cells = cells.where(F.col("value").isNotNull() | F.col("is_last"))
    return _chunk_summaries(cells, KEYS, spike)


def signal_anomalies(long: DataFrame, keys: Sequence[str] = KEYS, time: str = "time", value: str = "value",
                     tie: str | None = None, spike: float = 0.20, chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """Frozen readings and noise spikes of every sensor that ever read a value."""
    profile = signal_profile(long, keys, time, value, tie, spike, chunk_seconds)
    return profile.where(F.col("valid_readings") > 0).select(*keys, "frozen_signal_count", "noise_spikes_count")


def count_failures(quarantine: DataFrame, keys: Sequence[str] = (*KEYS, "error_reason"), name: str = "failure_count") -> DataFrame:
    return quarantine.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def real_failures(quarantine: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Failures other than bounds violations; a missing reason counts."""
    bounds = F.coalesce(F.lower("error_reason").contains("out of bounds"), F.lit(False))
    return count_failures(quarantine.where(~bounds), keys, "hardware_failures")


def hardware_failures(quarantine: DataFrame, dim: DataFrame) -> DataFrame:
    counted = enrich_brand(count_failures(quarantine), dim)
    return counted.select("case_id", "sensor_name", "equipment_brand", "error_reason", "failure_count")


def load_health_rules(path: str) -> dict[str, dict]:
    """Health rules from a JSON file: by sensor class a ``pattern`` and the three thresholds, ``standard`` for all others."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def _threshold(rules: Mapping[str, dict], field: str, name: Column) -> Column:
    """The last class in file order whose pattern occurs in the name wins, so the chain tests them backwards."""
    chain = None
    for kind, rule in reversed(rules.items()):
        if kind == "standard":
            continue
        hit, limit = name.rlike(rule["pattern"]), F.lit(float(rule[field]))
        chain = F.when(hit, limit) if chain is None else chain.when(hit, limit)
    fallback = F.lit(float(rules.get("standard", fv.HEALTH_RULES["standard"]).get(field, fv.HEALTH_RULES["standard"][field])))
    return fallback if chain is None else chain.otherwise(fallback)


def health_grade(df: DataFrame, rules: Mapping[str, dict] = fv.HEALTH_RULES) -> DataFrame:
    """Add ``health_grade`` from failure, null, spike and frozen rates and the thresholds of the sensor's class."""
    name = F.lower("sensor_name")
    max_nulls, max_frozen, max_spikes = (_threshold(rules, f, name) for f in ("max_nulls", "max_frozen_rate", "max_spike_rate"))
    failing = F.col("hardware_failures") / (F.col("sensor_active_seconds") + F.lit(1e-9)) * 100
    spiking = F.col("noise_spikes_count") / F.col("valid_readings") * 100
    frozen = F.col("frozen_signal_count") / F.col("valid_readings") * 100
    nulls = F.col("null_rate_percentage")
    grade = (
        F.when((failing > 5.0) | (nulls > max_nulls), fv.GRADE_CRITICAL)
        .when((nulls > max_nulls * 0.7) | (frozen > max_frozen) | (spiking > max_spikes) | (failing > 1.0), fv.GRADE_DEGRADED)
        .when((F.col("hardware_failures") > 0) | (nulls > 2.0), fv.GRADE_ACCEPTABLE)
        .otherwise(fv.GRADE_EXCELLENT)
    )
    return df.withColumn("health_grade", grade)


def grade_profile(profile: DataFrame, quarantine: DataFrame, dim: DataFrame, sample_seconds: float = 1,
                  rules: Mapping[str, dict] = fv.HEALTH_RULES) -> DataFrame:
    """Health summary from a signal profile and the quarantine log."""
    health = _rates(profile, sample_seconds).join(real_failures(quarantine), on=list(KEYS), how="left")
    health = health.withColumn("hardware_failures", F.coalesce("hardware_failures", F.lit(0)).cast("long"))
    return health_grade(enrich_brand(health, dim), rules).select(*HEALTH_COLUMNS)


def sensor_health(wide: DataFrame, quarantine: DataFrame, dim: DataFrame, tie: str | None = None,
                  sensors: Sequence[str] | None = None, spike: float = 0.20, sample_seconds: float = 1,
                  chunk_seconds: float = CHUNK_SECONDS, **grading) -> DataFrame:
    """Grade every sensor of every case from the wide clean table."""
    profile = signal_profile_wide(wide, tie=tie, sensors=sensors, spike=spike, chunk_seconds=chunk_seconds)
    return grade_profile(profile, quarantine, dim, sample_seconds, **grading)


def _reading_columns(long: DataFrame, value: bool = False) -> list[str]:
    """Case, sensor, time (and value) columns of long readings, found by their usual names."""
    found = [pick_column(long, ID_COLUMNS, "case column"), pick_column(long, SENSOR_COLUMNS, "sensor column"),
             pick_column(long, TIME_COLUMNS, "time column")]
    return found + ([pick_column(long, VALUE_COLUMNS, "value column")] if value else [])


def sensor_uptime(long: DataFrame, gap_seconds: float = 60) -> DataFrame:
    """Seconds each sensor was on (the total length of its sessions), and their share of the case."""
    case, sensor, time = _reading_columns(long)
    on = session_seconds(long, [case, sensor], time, gap_seconds)
    # a case has as many rows here as sensors
    whole = Window.partitionBy(case)
    span = F.nullif(seconds_between(F.min("first_time").over(whole), F.max("last_time").over(whole)), F.lit(0.0))
    return on.withColumn("surgery_seconds", span).select(
        case, sensor, F.col("on_seconds").alias("uptime_seconds"), "surgery_seconds",
        F.try_divide("on_seconds", "surgery_seconds").alias("uptime_rate"),
    )


def view_window(long: DataFrame, window_minutes: int = 5, low: float | None = None, high: float | None = None) -> DataFrame:
    """Mean, sample deviation and count per tumbling window; with a threshold also the critical share."""
    case, sensor, time, value = _reading_columns(long, value=True)
    rows = long.where(all_present([case, sensor, time])).select(
        case, sensor, F.window(time, f"{window_minutes} minutes").start.alias("window_start"), nan_to_null(value).alias("_v")
    )
    aggregates = [
        F.avg("_v").alias("avg_value"),
        F.stddev_samp("_v").alias("stddev_value"),
        F.count("_v").alias("n_samples"),
    ]
    if low is not None or high is not None:
        out = F.lit(False)
        if low is not None:
            out = out | (F.col("_v") < F.lit(low))
        if high is not None:
            out = out | (F.col("_v") > F.lit(high))
        aggregates.append(F.count_if(F.coalesce(out, F.lit(False))).alias("n_critical"))
    result = rows.groupBy(case, sensor, "window_start").agg(*aggregates)
    if len(aggregates) == 4:
        result = result.withColumn("pct_critical", F.try_divide("n_critical", "n_samples"))
    return result


def drift_pairs(sensors: Sequence[tuple] = tuple(fv.SENSORS)) -> list[tuple[str, str, str]]:
    """(parameter, sensor 1, sensor 2) of every two sensors that measure the same parameter."""
    return [(a[1], a[0], b[0]) for a, b in combinations(sensors, 2) if a[1] == b[1]]


def cross_sensor_drift(wide: DataFrame, pairs: Sequence[tuple[str, str, str]] | None = None,
                       case: str = "case_id", time: str = "time") -> DataFrame:
    """Absolute difference of both sensors of a pair at every instant both have a value. No shuffle."""
    usable = [p for p in (pairs if pairs is not None else drift_pairs()) if p[1] in wide.columns and p[2] in wide.columns]
    entries, any_pair = [], F.lit(False)
    for param, a, b in usable:
        gap = F.abs(lenient_double(wide, a) - lenient_double(wide, b))
        entries.append(F.struct(
            F.lit(param).alias("parameter_measured"), F.lit(a).alias("sensor_id_1"), F.lit(b).alias("sensor_id_2"), gap.alias("drift_value")))
        any_pair = any_pair | gap.isNotNull()
    kind = "array<struct<parameter_measured:string,sensor_id_1:string,sensor_id_2:string,drift_value:double>>"
    rows = wide.where(any_pair).select(F.col(case).alias("case_id"), F.col(time).alias("time"), F.inline(F.array(*entries).cast(kind)))
    return rows.where(F.col("drift_value").isNotNull())
