"""Repeatable stratified folds and splits.

Rows are ranked within a label by a seeded hash. Labels are few and large, so ranks are counted in hash
buckets and carried over; no task ever holds a whole label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perispark.operators.ordering import row_positions

HASH_BUCKETS = 16_384


def _hashed(df: DataFrame, key: str, label: str | None, seed: int) -> DataFrame:
    return df.withColumns({
        "_label": F.col(label) if label else F.lit(0),
        "_hash": F.xxhash64(F.col(key), F.lit(seed)),
    })


def _ranked(df: DataFrame, key: str, label: str | None, seed: int, buckets: int) -> DataFrame:
    chunk = F.pmod(F.col("_hash"), F.lit(buckets))
    return row_positions(_hashed(df, key, label, seed), ["_label"], ["_hash", key], chunk, "_rank", "_n").drop("_hash", "_label")


def assign_folds(df: DataFrame, k: int, key: str, label: str | None = None, seed: int = 42, name: str = "fold",
                 buckets: int = HASH_BUCKETS) -> DataFrame:
    """Add a fold number 0..k-1; within each label the folds differ by one row at most."""
    if k < 2:
        raise ValueError("need at least two folds")
    return _ranked(df, key, label, seed, buckets).withColumn(name, (F.col("_rank") % k).cast("int")).drop("_rank", "_n")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42, name: str = "is_test",
                     buckets: int = HASH_BUCKETS) -> DataFrame:
    """Add ``is_test`` for the first ``ceil(test_size * n)`` rows of every label.

    Rows are counted by hash bucket; only the bucket of a label in which its test part ends is put in order, all other
    rows lie on one side of it. No row is shuffled but those of that bucket.
    """
    rows = _hashed(df, key, label, seed).withColumn("_chunk", F.pmod(F.col("_hash"), F.lit(buckets)))
    whole = Window.partitionBy("_label")
    upto = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy("_label", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    sums = counts.select("_label", "_chunk", "_n", F.sum("_n").over(upto).alias("_upto"), F.ceil(F.sum("_n").over(whole) * F.lit(test_size)).alias("_cut"))
    # one row per label, so they are broadcast: the bucket that the cut falls into, and how many of its rows come before the cut
    ends = sums.where("_upto >= _cut").groupBy("_label").agg(F.min_by(F.struct("_chunk", (F.col("_cut") - F.col("_upto") + F.col("_n")).alias("_left")), "_chunk").alias("_end"))
    ends = ends.select(F.col("_label").alias("_of"), "_end.*").withColumnRenamed("_chunk", "_last")
    placed = rows.join(F.broadcast(ends), F.col("_label").eqNullSafe(F.col("_of")))
    order = Window.partitionBy("_label").orderBy(F.col("_hash"), F.col(key).asc_nulls_last())
    clear = placed.where("_chunk <> _last").withColumn(name, F.col("_chunk") < F.col("_last"))
    split = placed.where("_chunk = _last").withColumn(name, F.row_number().over(order) <= F.col("_left"))
    return clear.unionByName(split).select(*[F.col(f"`{c}`") for c in df.columns], name)
