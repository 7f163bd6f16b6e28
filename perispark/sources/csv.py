"""CSV feeds and the audit columns added on ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perispark.functions.columns import clean_nans, epoch_to_ts


def read_csv_feed(spark: SparkSession, path: str, schema: T.StructType | str | None = None, keep_empty_text: bool = False) -> DataFrame:
    """Read a headed CSV; pass ``schema`` for large feeds, as inference reads the files an extra time.

    An all-empty column is text. ``NaN`` counts as missing. ``keep_empty_text`` turns missing text into ''.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    void = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    df = clean_nans(df.withColumns(void) if void else df)
    if keep_empty_text:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.fillna("", subset=texts)
    return df


def with_audit(df: DataFrame, source: str, ts: dt.datetime | None = None) -> DataFrame:
    """Add ``ingest_time`` (one instant for the whole batch) and ``source_system``."""
    stamp = ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return df.withColumns({
        "source_system": F.lit(source),
        "ingest_time": F.lit(str(stamp)).cast("timestamp_ntz"),
    })


def read_or_fallback(spark: SparkSession, read, csv_path: str) -> DataFrame:
    """``read()``, or the CSV at ``csv_path`` when the table does not exist; other errors are not hidden.

    The time column is renamed to ``ts`` and parsed leniently in the fallback; numbers are seconds since 1970.
    """
    try:
        return read()
    except (FileNotFoundError, AnalysisException) as err:
        if isinstance(err, AnalysisException) and err.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"):
            raise
        missing = err
    try:
        df = spark.read.option("header", True).option("inferSchema", True).csv(csv_path)
    except AnalysisException as err:
        raise FileNotFoundError(f"no table and no fallback file at {csv_path!r}") from (missing or err)
    if not df.columns or df.isEmpty():
        raise ValueError(f"fallback file {csv_path!r} has no columns or no rows")
    for name in ("timestamp", "time"):
        if name in df.columns and "ts" not in df.columns:
            df = df.withColumnRenamed(name, "ts")
    if "ts" in df.columns:
        numeric = df.schema["ts"].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")
        df = df.withColumn("ts", epoch_to_ts("ts") if numeric else F.col("ts").cast("string").try_cast("timestamp_ntz"))
    return clean_nans(df)
