"""Silver laboratory results and the pre- against post-operative product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import lenient_double, normalize_columns, surgery_phase
from perispark.operators.filters import split_valid
from perispark.operators.joins import join_case_tables
from perispark.operators.ordering import flag_most_recent
from perispark.operators.reshape import pivot_phase


def labs_split(bronze: DataFrame, tie: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(results, quarantine); ``tie`` makes the order of results with equal ``dt`` total.

    Results are classified by surgery phase and the last one per case, test and phase is marked.
    """
    df = normalize_columns(bronze, "lower")
    df = df.withColumns({c: lenient_double(df, c) for c in ("result", "dt")})
    valid = F.col("caseid").isNotNull() & F.col("dt").isNotNull() & (F.col("result") >= 0)
    good, bad = split_valid(df, valid, fv.LAB_REASON)
    good = good.withColumn("surgery_phase", surgery_phase("dt"))
    return flag_most_recent(good, ["caseid", "name", "surgery_phase"], ["dt", *tie]), bad


def pre_vs_post(labs: DataFrame, demographics: DataFrame, surgery: DataFrame, method: str = "mean",
                order: Sequence[str] = ("dt",)) -> DataFrame:
    """Change of each test from before to after surgery, for cases that have both, with patient context."""
    pairs = pivot_phase(labs, method, order).where(F.col("PRE_OP").isNotNull() & F.col("POS_OP").isNotNull())
    delta = F.col("pos_op_avg") - F.col("pre_op_avg")
    # a zero start has no percentage: unbounded for a rise or fall, undefined for no change
    unbounded = F.when(delta > 0, F.lit(float("inf"))).when(delta < 0, F.lit(float("-inf")))
    percent = F.when(F.col("pre_op_avg") != 0, F.try_divide(delta, F.col("pre_op_avg")) * 100).otherwise(unbounded)
    result = pairs.select(
        "caseid", F.col("name").alias("lab_test"), F.col("PRE_OP").alias("pre_op_avg"), F.col("POS_OP").alias("pos_op_avg")
    ).withColumns({"absolute_delta": delta, "percent_delta": percent})
    return join_case_tables(result, demographics, surgery)
