"""Silver vital signs: typed, bounded, with a quarantine log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import clean_nans, epoch_to_ts, normalize_columns
from perispark.operators.filters import BoundsRule, TimeRule, run_filters


def vital_rules() -> list:
    return [TimeRule("time", checks=("null",))] + [BoundsRule(cols, lo, hi) for cols, lo, hi in fv.VITAL_BOUNDS]


def vitals_clean_quarantine(bronze: DataFrame, rules: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) from the raw wide feed; both are one shuffle-free pass over it.

    Time violations stay out of the quarantine, as a clock is not sensor hardware.
    """
    df = clean_nans(normalize_columns(bronze, "sensor"))
    if df.schema["time"].dataType.typeName() not in ("timestamp", "timestamp_ntz"):
        df = df.withColumn("time", epoch_to_ts("time"))
    clean, quarantine = run_filters(df, rules if rules is not None else vital_rules())
    return clean, quarantine.where(F.col("sensor_name") != "time")
