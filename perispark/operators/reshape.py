"""Wide to long and long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.fixed_values import AUDIT_COLUMNS, ID_COLUMNS, TIME_COLUMNS
from perispark.functions.columns import all_present, lenient_double, nan_to_null, pick_column

def to_long(df: DataFrame, ids: Sequence[str], sensors: Sequence[str] | None = None,
            name: str = "sensor_name", value: str = "reading") -> DataFrame:
    """One row per (row, sensor), nulls kept; without a list every column but ids and audit columns is a sensor.

    Cells are read one by one: text that is no number becomes null, the rest of its column stays.
    """
    ids = [c for c in ids if c in df.columns]
    sensors = list(sensors) if sensors is not None else [c for c in df.columns if c not in (*ids, *AUDIT_COLUMNS)]
    cells = df.select(*ids, *[lenient_double(df, c).alias(c) for c in sensors])
    return cells.unpivot([F.col(c) for c in ids], [F.col(f"`{c}`") for c in sensors], name, value)


def to_long_clean(df: DataFrame, tie: str | None = None) -> DataFrame:
    """(surgery_id, ts, sensor_id, value) of all usable cells; id and time columns are found by name."""
    case = pick_column(df, ID_COLUMNS, "case column")
    time = pick_column(df, TIME_COLUMNS, "time column")
    keep = [case, time] + ([tie] if tie else [])
    sensors = [c for c in df.columns if c not in (*keep, *AUDIT_COLUMNS)]
    if not sensors:
        raise ValueError(f"no sensor columns in {df.columns}")
    stamp = F.col(time).try_cast("timestamp_ntz") if df.schema[time].dataType.typeName() == "string" else F.col(time)
    cells = df.select(F.col(case).alias("surgery_id"), stamp.alias("ts"), *([tie] if tie else []),
                      *[lenient_double(df, c).alias(c) for c in sensors])
    ids = ["surgery_id", "ts"] + ([tie] if tie else [])
    long = cells.unpivot([F.col(c) for c in ids], [F.col(f"`{c}`") for c in sensors], "sensor_id", "value")
    return long.where(F.col("value").isNotNull() & F.col("ts").isNotNull())


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself, or an error when it is empty (looks at one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def lab_phase_avg(labs: DataFrame) -> DataFrame:
    """Mean result per case, test and phase; rows with a missing key belong to no group."""
    keys = ["caseid", "name", "surgery_phase"]
    return labs.where(all_present(keys)).groupBy(*keys).agg(F.avg(nan_to_null("result")).alias("result"))


def pivot_phase(labs: DataFrame, method: str = "mean", order: Sequence[str] = ("dt",)) -> DataFrame:
    """One row per (caseid, name) with PRE_OP and POS_OP; one aggregation instead of a group and a pivot."""
    if method not in ("mean", "latest"):
        raise ValueError(f"unknown method {method!r}")

    def phase(name: str):
        hit = F.when(F.col("surgery_phase") == name, F.col("result"))
        if method == "mean":
            return F.avg(hit).alias(name)
        position = F.when(F.col("surgery_phase") == name, F.struct(*[F.col(c) for c in order]))
        return F.max_by(F.col("result"), position).alias(name)

    return labs.where(all_present(["caseid", "name"])).groupBy("caseid", "name").agg(phase("PRE_OP"), phase("POS_OP"))


def pivot_labs(labs: DataFrame, names: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First non-null result of each listed test as ``preop_<name>``; the schema does not depend on the data."""

    def first(lab: str):
        hit = (F.col("name") == lab) & F.col("result").isNotNull()
        position = F.when(hit, F.struct(*[F.col(c) for c in order]))
        return F.min_by(F.col("result"), position).alias(f"preop_{lab}")

    return labs.where(F.col("caseid").isNotNull()).groupBy("caseid").agg(*[first(lab) for lab in names])
