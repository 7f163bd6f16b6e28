"""Operators that depend on row order, written so that no key has to fit in one task.

A case may hold a third of all readings, so nothing here opens a window over a whole case. Time is cut into
chunks: windows run inside (key, chunk), each chunk is reduced to one summary row, and only the summaries
(hours per case, not readings) are ordered across the whole key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perispark.functions.columns import all_present, epoch_micros, micros_between, seconds_between
from perispark.session import use_checkpoint_dir

CHUNK_SECONDS = 3600
CELLS_PER_CHUNK = 10_000


def time_chunk(time: Column | str, chunk_seconds: float = CHUNK_SECONDS) -> Column:
    """Number of the epoch-aligned time chunk; rises with time, so chunks of a key are in time order."""
    return F.floor(epoch_micros(time) / F.lit(chunk_seconds * 1e6)).cast("long")


def _order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key (null keys form one group): the last by ``order``.

    ``max_by`` combines on the map side, so a key repeated without end costs one row per map task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    last = F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("_row")
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(last).select("_row.*")


def flag_most_recent(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str = "is_most_recent") -> DataFrame:
    """Mark the last row of each key (null keys form one); ``order`` must end in a column unique within the key.

    The last position per key is a map-side-combined maximum joined back. Joining on a hash as well gives the
    maxima a shuffle of their own after the aggregation: with plain shuffles on both sides AQE can split a hot
    key (or broadcast a small side). The key is one struct: structs match null fields, and a plan that never
    reads the flag loses the whole join.
    """
    key = F.struct(*[F.col(k) for k in keys])
    position = F.struct(*[F.col(c) for c in order])
    last = df.groupBy(key.alias("_key")).agg(F.max(position).alias("_last"))
    joined = df.join(last, (key == F.col("_key")) & (F.hash(key) == F.hash("_key")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(position == F.col("_last"), F.lit(False)).alias(flag))


def _gap_cells(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: float, cells_per_chunk: int) -> DataFrame:
    """Readings folded into cells of ``gap_seconds``: first and last time, and the gap before within a chunk.

    Two readings in one cell are less than the limit apart, so a cell never spans two sessions: the readings
    are reduced to one row per cell before they are shuffled. Cells are put in order chunk by chunk.
    """
    cells = (
        df.where(all_present([*keys, time]))
        .groupBy(*keys, _cell(time, gap_seconds).alias("_cell"))
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
        .withColumn("_chunk", F.floor(F.col("_cell") / F.lit(_cells_in_chunk(gap_seconds, cells_per_chunk))).cast("long"))
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy("_cell")
    return cells.withColumn("_gap", micros_between(F.lag("_last").over(w), "_first"))


def _cells_in_chunk(gap_seconds: float, cells_per_chunk: int) -> int:
    """Cells of a chunk: a chunk is never shorter than ``CHUNK_SECONDS``, so a key has at most one per hour it lasts."""
    return max(cells_per_chunk, math.ceil(CHUNK_SECONDS / _width(gap_seconds)))


def _width(gap_seconds: float) -> float:
    return gap_seconds if gap_seconds > 0 else 1e-6


def _chunk_gaps(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The gap before each chunk's first reading."""
    across = Window.partitionBy(*keys).orderBy("_chunk")
    return chunks.withColumn("_entry", micros_between(F.lag("_end").over(across), "_start"))


def session_seconds(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: float = 60,
                    cells_per_chunk: int = CELLS_PER_CHUNK) -> DataFrame:
    """Total length of a key's sessions (``on_seconds``) with its first and last reading.

    A session is as long as its gaps together, so all gaps within the limit are added up and no session has
    to be numbered. Whole microseconds make the sum exact.
    """
    limit = F.lit(gap_seconds * 1e6)
    inner = F.sum(micros_between("_first", "_last") + F.when(F.col("_gap") <= limit, F.col("_gap")).otherwise(0))
    chunks = _gap_cells(df, keys, time, gap_seconds, cells_per_chunk).groupBy(*keys, "_chunk").agg(
        inner.alias("_on"), F.min("_first").alias("_start"), F.max("_last").alias("_end")
    )
    total = F.sum(F.col("_on") + F.when(F.col("_entry") <= limit, F.col("_entry")).otherwise(0))
    return _chunk_gaps(chunks, keys).groupBy(*keys).agg(
        (total / F.lit(1e6)).alias("on_seconds"), F.min("_start").alias("first_time"), F.max("_end").alias("last_time")
    )


def session_cells(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: float = 60,
                  cells_per_chunk: int = CELLS_PER_CHUNK) -> DataFrame:
    """Cells with the session they belong to: ``seg_id`` from 1 = sessions begun in earlier chunks and in this one."""
    limit = F.lit(gap_seconds * 1e6)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = _gap_cells(df, keys, time, gap_seconds, cells_per_chunk)
    cells = cells.withColumn("_begun", F.sum(F.when(F.col("_gap") > limit, 1).otherwise(0)).over(w))
    chunks = cells.groupBy(*keys, "_chunk").agg(
        F.max("_begun").alias("_inner"), F.min("_first").alias("_start"), F.max("_last").alias("_end")
    )
    upto = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.when(F.col("_entry") <= limit, 0).otherwise(1)
    offsets = _chunk_gaps(chunks, keys).withColumn("_begins", begins).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_kc"),
        (F.sum(F.col("_begins") + F.col("_inner")).over(upto) - F.col("_inner")).alias("_offset"),
    )
    cond = F.col("_chunk") == F.col("_kc")
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    return cells.join(offsets, cond).select(
        *keys, "_cell", "_first", "_last", (F.col("_offset") + F.col("_begun")).cast("long").alias("seg_id")
    )


def _cell(time: str, gap_seconds: float) -> Column:
    return F.floor(epoch_micros(time) / F.lit(_width(gap_seconds) * 1e6)).cast("long")


def gap_segments(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: float = 60,
                 cells_per_chunk: int = CELLS_PER_CHUNK) -> DataFrame:
    """Add ``seg_id``: sessions of each key, numbered from 1; a new one starts after a gap longer than ``gap_seconds``.

    Rows look their cell up by (key, cell), so a long key is spread over its cells.
    """
    cells = session_cells(df, keys, time, gap_seconds, cells_per_chunk).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_cell").alias("_of"), "seg_id"
    )
    rows = df.where(all_present([*keys, time])).withColumn("_cell", _cell(time, gap_seconds))
    cond = F.col("_cell") == F.col("_of")
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    return rows.join(cells, cond).select(*[F.col(f"`{c}`") for c in df.columns], "seg_id")


def segment_spans(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: float = 60,
                  cells_per_chunk: int = CELLS_PER_CHUNK) -> DataFrame:
    """Start, end and length of every session."""
    return (
        session_cells(df, keys, time, gap_seconds, cells_per_chunk)
        .groupBy(*keys, "seg_id")
        .agg(F.min("_first").alias("seg_start"), F.max("_last").alias("seg_end"))
        .withColumn("seg_seconds", seconds_between("seg_start", "seg_end"))
    )


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str = "pos",
                  total: str | None = None) -> DataFrame:
    """Row number from 0 within a key, and on request the rows of the key, counted chunk by chunk.

    ``chunk`` must rise with ``order``. Rows are numbered inside (key, chunk) and shifted by the rows of earlier
    chunks, which they look up by the same (key, chunk) they are already partitioned by.
    """
    rows = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*_order(order))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(F.col("_chunk").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        rows.groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_chunk").alias("_kc"),
            (F.sum("_n").over(upto) - F.col("_n")).alias("_offset"),
            *([F.sum("_n").over(whole).alias("_total")] if total else []),
        )
    )
    cond = F.col("_chunk").eqNullSafe(F.col("_kc"))
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = rows.withColumn("_rn", F.row_number().over(w).cast("long"))
    return ranked.join(offsets, cond).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_offset") + F.col("_rn") - F.lit(1)).alias(name),
        *([F.col("_total").alias(total)] if total else []),
    )


def signal_smoothing(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    tie: str,
    rows: int = 20,
    chunk_seconds: float = CHUNK_SECONDS,
    block_rows: int = 100_000,
) -> DataFrame:
    """Mean and sample deviation of the trailing ``rows`` readings, beside the raw one.

    Rows get a position within their key, positions are cut into blocks, and the last ``rows - 1`` of a
    block are copied into the next, so frames never reach outside a block and no block outgrows a task.
    """
    base = df.where(all_present(keys)).select(*keys, time, tie, value)
    placed = row_positions(base, keys, [time, tie], time_chunk(time, chunk_seconds))
    block = F.floor(F.col("pos") / F.lit(block_rows)).cast("long")
    into_next = F.col("pos") % F.lit(block_rows) >= F.lit(block_rows - rows + 1)
    copies = F.when(into_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = placed.withColumn("_halo", F.explode(copies)).withColumn("_block", block + F.col("_halo"))
    frame = Window.partitionBy(*keys, "_block").orderBy("pos").rowsBetween(1 - rows, Window.currentRow)
    return (
        spread.withColumn("moving_avg", F.avg(value).over(frame))
        .withColumn("moving_std", F.stddev_samp(value).over(frame))
        .where(F.col("_halo") == 0)
        .select(*keys, time, tie, value, "moving_avg", "moving_std")
    )


def running_totals(df: DataFrame, value: str, sums: Sequence[str], descending: bool = False, buckets: int | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    """Running totals (``cum_<name>``) in order of a distinct-valued column, over the whole table or within ``by``.

    There is no one-task window: rows are dealt to ranges of (``by``, value), as many as the shuffle has partitions (or
    ``buckets``), and stored once; totals run inside a range, and the totals of the ranges before, one row per range and
    group, carry over.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    keys = [*[F.col(c).asc() for c in by], order]
    dealt = df.repartitionByRange(buckets, *keys) if buckets else df.repartitionByRange(*keys)
    use_checkpoint_dir(df.sparkSession)
    ranged = dealt.withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums]).select(
        *by, "_range", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_c_{s}") for s in sums]
    )
    running = ranged.select("*", *[F.sum(s).over(inside).alias(f"_r_{s}") for s in sums])
    return running.join(carried, [*by, "_range"]).select(
        *df.columns, *[(F.col(f"_r_{s}") + F.col(f"_c_{s}")).alias(f"cum_{s}") for s in sums]
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; planned as a top-k per partition and a merge of at most ``k`` rows each."""
    return df.orderBy(*order).limit(k)


def sample_n(df: DataFrame, key: str | Sequence[str], n: int = 100, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same for a given seed whatever the partitioning: the first by the MD5 of the key."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(F.encode(text, "UTF-8")), *keys).limit(n)


def after_watermark(new: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Rows of ``new`` past the highest loaded ``column``; everything when nothing is loaded yet."""
    mark = loaded.agg(F.max(column)).scalar()
    return new.where(mark.isNull() | (F.col(column) > mark))


def exact_quantiles(df: DataFrame, value: str, ranks: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``rank``, ``value`` and ``n`` (values that count): quantiles, interpolated between neighbours.

    Values are counted, put in order in ranges and cumulated, so a group with a third of all rows is many tasks. Nulls do not
    count; a group without values has no rows. Of n values, rank q lies at place q * (n - 1).
    """
    if any(not 0 <= q <= 1 for q in ranks):
        raise ValueError(f"ranks lie between 0 and 1: {list(ranks)}")
    keys = [f"_k{i}" for i in range(len(by))]
    cells = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = cells.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # one struct as group: structs match null fields in the joins below
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_k"))
    ranked = running_totals(counted.select(group.alias("_g"), "_v", "_n"), "_v", ["_n"], by=["_g"])
    totals = ranked.groupBy("_g").agg(F.sum("_n").alias("_total")).withColumn("rank", F.explode(F.array(*[F.lit(float(q)) for q in ranks])))
    place = F.col("rank") * (F.col("_total") - 1)
    low = F.min(F.when(F.col("cum__n") >= F.floor(place) + 1, F.col("_v")))
    high = F.min(F.when(F.col("cum__n") >= F.ceil(place) + 1, F.col("_v")))
    found = ranked.join(totals, "_g").groupBy("_g", "rank").agg(low.alias("_low"), high.alias("_high"), F.max("_total").alias("n"), F.max(place - F.floor(place)).alias("_part"))
    return found.select(*[F.col(f"_g.{k}").alias(c) for c, k in zip(by, keys)], "rank", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("value"), "n")
