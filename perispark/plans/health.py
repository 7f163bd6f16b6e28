"""Sensor health kept up to date: states of time chunks are stored by day, and only days with new rows are made anew."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.operators import sensors as s
from perispark.sources.lake import Lake

CLEAN, CHUNKS = ("silver", "vitals_clean"), ("gold", "sensor_health_chunks")
DAY_SECONDS = 86_400


def append_clean(lake: Lake, batch: DataFrame) -> bool:
    """Add clean wide rows to the stored table; the marker keeps their span of time."""
    return lake.write(batch, *CLEAN, mode="append", bounds=["time"])


def refresh_chunks(lake: Lake, batch: DataFrame, tie: str | None = None, sensors=None, spike: float = 0.20,
                   chunk_seconds: float = s.CHUNK_SECONDS) -> list[str]:
    """Make the chunk states of the days of a batch anew from all stored rows of those days; return the days.

    Chunks must not reach over midnight (UTC). Neighbouring days are read as one span, so few scans serve many days, and stored batches
    outside the spans are not opened. A batch without rows changes nothing.
    """
    if DAY_SECONDS % chunk_seconds:
        raise ValueError("a day has to be a whole number of chunks")
    days = [r[0] for r in batch.where(F.col("time").isNotNull()).select(F.to_date("time")).distinct().collect()]  # one row per day
    spans: list[list] = []
    for day in sorted(d for d in days if d is not None):
        if spans and (day - spans[-1][1]).days == 1:
            spans[-1][1] = day
        else:
            spans.append([day, day])
    rows = None
    for first, last in spans:
        some = lake.read_range(*CLEAN, "time", str(first), str(last + timedelta(days=1)))
        rows = some if rows is None else rows.unionByName(some)
    if rows is None:
        return []
    states = s.chunk_states(rows, tie=tie, sensors=sensors, spike=spike, chunk_seconds=chunk_seconds)
    states = states.withColumn("day", F.date_from_unix_date((F.col("_chunk") * int(chunk_seconds) / DAY_SECONDS).cast("int")).cast("string"))
    lake.write_parts(states, *CHUNKS, part="day")
    return [str(d) for d in sorted(days)]


def stored_health(lake: Lake, quarantine: DataFrame, dim: DataFrame, spike: float = 0.20, sample_seconds: float = 1, **grading) -> DataFrame:
    """The health summary from the stored chunk states: what :func:`sensors.sensor_health` gives for all rows."""
    profile = s.profile_of_chunks(lake.read(*CHUNKS).drop("day"), spike)
    return s.grade_profile(profile, quarantine, dim, sample_seconds, **grading)
