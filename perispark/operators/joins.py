"""Joins with a fixed meaning. No side is hinted for broadcast unless its row count is fixed by construction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.functions.columns import brand_from_name


def enrich_brand(df: DataFrame, dim: DataFrame, sensor: str = "sensor_name") -> DataFrame:
    """Add ``equipment_brand``: from the dimension, else from the sensor name.

    The dimension is left to AQE's size-based broadcast, as callers may pass one of any size.
    """
    brands = dim.select(F.col("sensor_id").alias("_sensor"), F.col("equipment_brand"))
    joined = df.join(brands, F.col(sensor) == F.col("_sensor"), "left")
    return joined.withColumn("equipment_brand", F.coalesce("equipment_brand", brand_from_name(sensor))).drop("_sensor")


def keep_active(df: DataFrame, active: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``active``.

    Joining on a hash of the key as well keeps the join from reusing an aggregation's partitioning, so AQE
    can split a hot key.
    """
    known = active.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    cond = F.hash(*keys) == F.hash(*known.columns)
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    return df.join(known, cond, "left_semi")


def join_case_tables(left: DataFrame, *others: DataFrame, how: str = "inner") -> DataFrame:
    """Chain of equi-joins on ``caseid``."""
    for other in others:
        left = left.join(other, on="caseid", how=how)
    return left
