"""Row-local cleaning rules with a quarantine log.

A rule rewrites column expressions instead of a frame, so a whole chain becomes one projection for the
clean rows and one generator for the quarantine rows: a scan each, no shuffle, however many rules there are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perispark.functions.columns import epoch_seconds, lenient_cell, nan_to_null

QUARANTINE_TYPE = "struct<case_id:{case},time:{time},sensor_name:string,original_value:double,error_reason:string>"


@dataclass
class BoundsRule:
    """Values at or beyond a bound are nulled and logged (both bounds are themselves bad)."""

    columns: Sequence[str]
    low: float | None = None
    high: float | None = None

    def rewrite(self, cells: dict[str, Column], df: DataFrame):
        hits = []
        reason = F.lit(f"Out of bounds (min: {self.low}, max: {self.high})")
        for name in self.columns:
            if name not in cells:
                continue
            value = lenient_cell(cells[name], df.schema[name].dataType) if name in df.columns else nan_to_null(cells[name].cast("double"))
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | (value <= F.lit(self.low))
            if self.high is not None:
                bad = bad | (value >= F.lit(self.high))
            bad = F.coalesce(bad, F.lit(False))
            hits.append((bad, name, value, reason))
            cells[name] = F.when(~bad, cells[name])
        return hits


@dataclass
class TimeRule:
    """A null or future time is logged and nulled; ``limit`` defaults to the moment the rule is compiled."""

    column: str = "time"
    checks: Sequence[str] = ("null", "future")
    limit: dt.datetime | float | None = None
    limit_text: str | None = None

    def rewrite(self, cells: dict[str, Column], df: DataFrame):
        if self.column not in cells:
            return []
        value = cells[self.column]
        numeric = df.schema[self.column].dataType.typeName() in ("double", "float", "long", "integer")
        limit = self.limit
        if limit is None:
            now = dt.datetime.now(dt.timezone.utc)
            limit = now.timestamp() if numeric else now.replace(tzinfo=None)
        literal = F.lit(limit) if numeric else F.lit(str(limit)).cast("timestamp_ntz")
        present = nan_to_null(value.cast("double")) if numeric else value
        is_null = present.isNull() if "null" in self.checks else F.lit(False)
        future = F.coalesce(present > literal, F.lit(False)) if "future" in self.checks else F.lit(False)
        bad = is_null | future
        reason = F.when(present.isNull(), F.lit("Time is Null")).otherwise(
            F.lit(f"Future Date (> {self.limit_text or limit})")
        )
        original = present if numeric else epoch_seconds(value)
        cells[self.column] = F.when(~bad, value)
        # the log keeps the time as it was read
        return [(bad, self.column, original, reason, value)]


def run_filters(df: DataFrame, rules: Sequence, case: str = "case_id", time: str = "time") -> tuple[DataFrame, DataFrame]:
    """Apply rules in order; return (clean rows, quarantine rows).

    Built-in rules are fused. Anything else is called as ``rule(df) -> (clean, quarantine)``, the plug-in
    interface; its log is added with a union.
    """
    logs: list[DataFrame] = []
    pending: list = []

    def flush(frame: DataFrame) -> DataFrame:
        if not pending:
            return frame
        clean, log = _run_fused(frame, pending, case, time)
        logs.append(log)
        pending.clear()
        return clean

    current = df
    for rule in rules:
        if hasattr(rule, "rewrite"):
            pending.append(rule)
            continue
        current = flush(current)
        current, log = rule(current)
        logs.append(log)
    current = flush(current)
    if not logs:
        logs = [_run_fused(df, [], case, time)[1]]
    quarantine = logs[0]
    for log in logs[1:]:
        quarantine = quarantine.unionByName(log, allowMissingColumns=True)
    return current, quarantine


def _run_fused(df: DataFrame, rules: Sequence, case: str, time: str) -> tuple[DataFrame, DataFrame]:
    cells: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    case_type = df.schema[case].dataType.simpleString() if case in cells else "bigint"
    time_type = df.schema[time].dataType.simpleString() if time in cells else "timestamp_ntz"
    row_type = QUARANTINE_TYPE.format(case=case_type, time=time_type)
    entries, any_bad = [], F.lit(False)
    for rule in rules:
        state = dict(cells)
        for hit in rule.rewrite(cells, df):
            bad, name, original, reason = hit[:4]
            shown_time = hit[4] if len(hit) > 4 else state.get(time, F.lit(None))
            entry = F.struct(
                cells.get(case, F.lit(None)).cast(case_type).alias("case_id"),
                shown_time.cast(time_type).alias("time"),
                F.lit(name).alias("sensor_name"),
                original.cast("double").alias("original_value"),
                reason.alias("error_reason"),
            )
            entries.append(F.when(bad, entry))
            any_bad = any_bad | bad
    clean = df.select(*[expr.alias(name) for name, expr in cells.items()])
    # good rows leave before the generator, which keeps both inside generated code
    rows = df.where(any_bad).select(F.inline(F.array(*entries).cast(f"array<{row_type}>")))
    return clean, rows.where(F.col("error_reason").isNotNull())


def bounds_filter(df: DataFrame, columns: Sequence[str], low=None, high=None, case="case_id", time="time"):
    return run_filters(df, [BoundsRule(columns, low, high)], case, time)


def time_filter(df: DataFrame, column="time", checks=("null", "future"), limit=None, limit_text=None, case="case_id"):
    return run_filters(df, [TimeRule(column, checks, limit, limit_text)], case, column)


def split_valid(df: DataFrame, valid: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows where ``valid`` is true, and all the others (false or unknown) with a reason."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok).withColumn("error_reason", F.lit(reason))


def split_columns(df: DataFrame, groups: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Vertical split; each group takes those of its columns that exist."""
    return {g: df.select(*[c for c in names if c in df.columns]) for g, names in groups.items()}
