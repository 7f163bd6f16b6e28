"""Column helpers shared by all operators; every one is a native Spark expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric column names of ``df`` in schema order."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and f.dataType.typeName() in
        ("byte", "short", "integer", "long", "float", "double", "decimal")
    ]


def normalize_name(name: str, style: str = "lower") -> str:
    """``lower``: strip and lower-case; ``snake``: also blanks to ``_``; ``sensor``: ``/`` and blanks to ``_``, no strip."""
    if style == "lower":
        return name.strip().lower()
    if style == "snake":
        return name.strip().lower().replace(" ", "_")
    if style == "sensor":
        return name.replace("/", "_").replace(" ", "_").lower()
    raise ValueError(f"unknown style {style!r}")


def normalize_columns(df: DataFrame, style: str = "lower") -> DataFrame:
    """Rename every column with :func:`normalize_name`; two columns that fall together are an error."""
    names = [normalize_name(c, style) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names fall together after normalisation: {clash}")
    return df.toDF(*names)


def pick_column(df: DataFrame, candidates: Sequence[str], what: str = "column") -> str:
    """First of ``candidates`` present in ``df``; an error naming the columns when none is."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no {what} among {list(candidates)}; columns are {df.columns}")


def nan_to_null(c: Column | str) -> Column:
    """NaN means missing in the sources; Spark orders it above every number, so it becomes null on ingest."""
    return F.nullif(as_col(c), F.lit(float("nan")))


def clean_nans(df: DataFrame) -> DataFrame:
    """NaN to null in every float column."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: nan_to_null(f"`{c}`") for c in floats}) if floats else df


def to_numeric(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number (also Spark's ``1d``) becomes null."""
    text = as_col(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def lenient_double(df: DataFrame, name: str) -> Column:
    """:func:`to_numeric` for text columns, a plain cast with NaN to null for numeric ones."""
    return lenient_cell(F.col(f"`{name}`"), df.schema[name].dataType)


def lenient_cell(col: Column, kind: DataType) -> Column:
    """:func:`lenient_double` of an expression of a known type."""
    if kind.typeName() in ("string", "char", "varchar"):
        return to_numeric(col)
    return nan_to_null(col.cast("double"))


def epoch_to_ts(c: Column | str) -> Column:
    """Fractional Unix seconds to a zone-free timestamp in microseconds."""
    return F.timestamp_seconds(nan_to_null(as_col(c).cast("double"))).cast("timestamp_ntz")


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970. Zone-free times count as UTC, the session's zone."""
    return F.unix_micros(as_col(c).cast("timestamp"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return epoch_micros(end) - epoch_micros(start)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(1e6)


def epoch_seconds(c: Column | str) -> Column:
    return epoch_micros(c) / F.lit(1e6)


def std_text(c: Column | str) -> Column:
    """Upper-case without outer blanks; null stays null."""
    return F.trim(F.upper(as_col(c)))


def map_labels(c: Column | str, labels: Mapping[str, str], fallback: str = "same") -> Column:
    """Case-insensitive code to label; unknown codes stay as they are or go to upper case."""
    col = as_col(c)
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    other = F.upper(col) if fallback == "upper" else col
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(col)), other)


def brand_from_name(c: Column | str) -> Column:
    """Brand guessed from the first token of a sensor name."""
    token = F.split_part(F.lower(as_col(c)), F.lit("_"), F.lit(1))
    return F.when(token == "bis", F.lit("BIS")).otherwise(
        F.concat(F.upper(F.substring(token, 1, 1)), F.substring(token, F.lit(2), F.length(token)))
    )


def surgery_phase(dt: Column | str) -> Column:
    """Events before the operation (negative offset) are PRE_OP, all others POS_OP."""
    return F.when(as_col(dt) < 0, F.lit("PRE_OP")).otherwise(F.lit("POS_OP"))


def binary_target(c: Column | str) -> Column:
    return (as_col(c) > 0).cast("int")


def opt_filter(df: DataFrame, name: str, value, everything: str = "Todos") -> DataFrame:
    """Equality or membership filter; ``None`` or ``everything`` keeps all rows."""
    if value is None or value == everything:
        return df
    if isinstance(value, (list, tuple, set)):
        return df.where(F.col(name).isin(*value))
    return df.where(F.col(name) == F.lit(value))


def all_present(names: Iterable[str]) -> Column:
    """True when none of the named columns is null; groupings drop rows with a null key."""
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).isNotNull()
    return cond
