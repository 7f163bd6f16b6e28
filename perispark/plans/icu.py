"""Feature table for the ICU-stay models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import lenient_double
from perispark.operators.joins import join_case_tables
from perispark.operators.reshape import pivot_labs


def icu_features(demographics: DataFrame, surgery: DataFrame, labs: DataFrame,
                 preop_labs: Sequence[str] = tuple(fv.PREOP_LABS), order: Sequence[str] = ("dt",)) -> DataFrame:
    """One row per case with a known ICU stay: patient, surgery and last pre-operative lab values."""
    preop = labs.where(
        (F.col("surgery_phase") == "PRE_OP") & F.col("is_most_recent") & F.col("name").isin(*preop_labs)
    )
    base = join_case_tables(
        demographics.select(*fv.ICU_PATIENT_COLUMNS), surgery.select(*fv.ICU_SURGERY_COLUMNS),
    )
    table = join_case_tables(base, pivot_labs(preop, preop_labs, order), how="left")
    numbers = ["age", "bmi", "asa", *[f"preop_{lab}" for lab in preop_labs], fv.ICU_TARGET]
    table = table.withColumns({c: lenient_double(table, c) for c in numbers}).where(F.col(fv.ICU_TARGET).isNotNull())
    known = [c for c in fv.ICU_SURGERY_COLUMNS if c not in ("caseid", fv.ICU_TARGET)]
    return table.select(*fv.ICU_PATIENT_COLUMNS, *known, *[f"preop_{lab}" for lab in preop_labs], fv.ICU_TARGET)


def features_for_case(features: DataFrame, caseid: int) -> DataFrame:
    """The row of one case, or an error; the typed comparison reaches the Parquet scan."""
    found = features.where(F.col("caseid") == F.lit(caseid)).head(2)  # a case has one row; two would be a broken table
    if not found:
        raise ValueError(f"no data for caseid={caseid!r}")
    return features.sparkSession.createDataFrame(found, features.schema)
