"""Change-aware upsert: insert new keys, replace rows whose business columns differ, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, DoubleType, FractionalType, IntegralType, NullType, NumericType, StructType, TimestampNTZType, TimestampType,
)

from perispark.fixed_values import UPSERT_IGNORED, UPSERT_KEYS

KEYS, IGNORED = UPSERT_KEYS, UPSERT_IGNORED


def common_type(name: str, a: DataType, b: DataType) -> DataType:
    """The type both are widened to; kinds that do not mix, and decimals that no decimal holds, are an error.

    A double stands for numbers of both kinds, fractions and large whole numbers: see :func:`widened`.
    """
    if a == b:
        return a
    times = (DateType, TimestampType, TimestampNTZType)
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        whole = [t for t in (a, b) if isinstance(t, IntegralType)]
        if len(whole) == 2:
            return max(whole, key=lambda t: ("byte", "short", "integer", "long").index(t.typeName()))
        if any(isinstance(t, DecimalType) for t in (a, b)):
            x, y = (t if isinstance(t, DecimalType) else DecimalType(20, 0) if isinstance(t, IntegralType) else None for t in (a, b))
            if x is None or y is None:
                return DoubleType()
            scale = max(x.scale, y.scale)
            digits = max(x.precision - x.scale, y.precision - y.scale) + scale
            if digits > 38:
                raise TypeError(f"column {name!r}: no decimal holds both {a.simpleString()} and {b.simpleString()}")
            return DecimalType(digits, scale)
        return DoubleType()
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if isinstance(a, times) and isinstance(b, times):
        return TimestampNTZType() if TimestampNTZType() in (a, b) else TimestampType()
    raise TypeError(f"column {name!r} is {a.simpleString()} in the table and {b.simpleString()} in the batch")


def widened(value: Column, kind: DataType, to: DataType) -> Column:
    """``value`` (of type ``kind``) as ``to``, where no value may change by it.

    A whole or decimal number that a double cannot hold exactly, such as 2**53 + 1, is an error when it is met.
    """
    out = value.cast(to)
    exact = isinstance(kind, DecimalType) or kind.typeName() == "long"
    if not exact or not isinstance(to, DoubleType):
        return out
    back = out.cast(kind if isinstance(kind, DecimalType) else DecimalType(20, 0))
    same = value.isNull() | F.coalesce(back == value, F.lit(False))
    return F.when(same, out).otherwise(F.raise_error(F.concat(F.lit("no double holds "), value.cast("string"))).cast("double"))


def match_versions(current: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS,
                   ignore: Sequence[str] = IGNORED) -> DataFrame:
    """Both versions of every key side by side as structs ``cur`` and ``new`` with a ``status``.

    One null-safe full outer join gives inserts, updates, unchanged and kept rows together. Both sides are widened to
    their common types, never narrowed. A column that one side lacks counts as null there; what the batch lacks is not
    compared, and stays in the table.
    """
    columns = [*new.columns, *[c for c in current.columns if c not in new.columns]]

    def side(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
        cells = []
        for c in columns:
            kind = (common_type(c, current.schema[c].dataType, new.schema[c].dataType) if c in df.columns and c in other.columns
                    else (df if c in df.columns else other).schema[c].dataType)
            cells.append((widened(F.col(f"`{c}`"), df.schema[c].dataType, kind) if c in df.columns else F.lit(None).cast(kind)).alias(c))
        return df.select(F.struct(*cells).alias(name))

    a, b = side(current, new, "cur"), side(new, current, "new")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"cur.`{k}`").eqNullSafe(F.col(f"new.`{k}`"))
    changed = F.lit(False)
    for c in new.columns:
        if c not in (*keys, *ignore):
            changed = changed | ~F.col(f"cur.`{c}`").eqNullSafe(F.col(f"new.`{c}`"))
    status = (
        F.when(F.col("cur").isNull(), "insert")
        .when(F.col("new").isNull(), "keep")
        .when(changed, "update")
        .otherwise("same")
    )
    return a.join(b, cond, "full_outer").withColumn("status", status)


def merged(matched: DataFrame, batch_columns: Sequence[str], mark: str | None = None) -> DataFrame:
    """The next snapshot from matched versions: changed rows take the batch's columns and keep the others; ``mark`` names a column that tells them."""
    taken = F.col("status").isin("insert", "update")
    columns = matched.schema["cur"].dataType.names
    return matched.select(*[
        (F.when(taken, F.col(f"new.`{c}`")).otherwise(F.col(f"cur.`{c}`")) if c in batch_columns else F.col(f"cur.`{c}`")).alias(c)
        for c in columns
    ], *([taken.alias(mark)] if mark else []))


def upsert(current: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS,
           ignore: Sequence[str] = IGNORED) -> DataFrame:
    """The next snapshot. Keys must be unique on both sides (see ``Lake.upsert`` for the checked form)."""
    return merged(match_versions(current, new, keys, ignore), new.columns)


def change_log(current: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS,
               ignore: Sequence[str] = IGNORED) -> DataFrame:
    """One row per changed field of an updated record: key columns, column name, old and new value as text."""
    values = [c for c in new.columns if c not in (*keys, *ignore)]
    matched = match_versions(current, new, keys, ignore).where(F.col("status") == "update")
    fields = F.array(*[
        F.when(
            ~F.col(f"cur.`{c}`").eqNullSafe(F.col(f"new.`{c}`")),
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"cur.`{c}`").cast("string").alias("old_value"),
                F.col(f"new.`{c}`").cast("string").alias("new_value"),
            ),
        )
        for c in values
    ])
    return matched.select(*[F.col(f"new.`{k}`").alias(k) for k in keys], F.inline(F.filter(fields, lambda f: f.isNotNull())))


def bucket_of(schema: StructType, keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by a hash of its keys; whole numbers hash alike whatever their width, and so do fractions."""
    cells = []
    for k in keys:
        kind = schema[k].dataType
        whole, fraction = isinstance(kind, IntegralType), isinstance(kind, FractionalType) and not isinstance(kind, DecimalType)
        cells.append(F.col(f"`{k}`").cast("long" if whole else "double" if fraction else kind))
    return F.pmod(F.xxhash64(*cells), F.lit(buckets)).cast("int")


def key_kinds(schema: StructType, keys: Sequence[str]) -> list[str]:
    """How each key is hashed: two tables with equal kinds put equal keys in equal buckets."""
    kinds = [schema[k].dataType for k in keys]
    return ["whole" if isinstance(t, IntegralType) else "fraction" if isinstance(t, FractionalType) and not isinstance(t, DecimalType) else t.simpleString() for t in kinds]
