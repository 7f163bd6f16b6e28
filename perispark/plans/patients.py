"""Silver patients: deduplicated, validated and split into demographics and surgery context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import lenient_double, normalize_columns, std_text
from perispark.operators.filters import split_columns, split_valid
from perispark.operators.ordering import dedupe_keep_last


def patients_split(bronze: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(demographics, surgery, quarantine); ``order`` says which record of a case is the last one."""
    df = normalize_columns(bronze, "lower")
    numeric = {c: lenient_double(df, c) for c in fv.PATIENT_NUMERIC if c in df.columns}
    if df.schema["caseid"].dataType.typeName() in ("long", "integer"):
        numeric.pop("caseid")  # already a number; a double would lose large ids
    df = df.withColumns(numeric)
    df = dedupe_keep_last(df, ["caseid"], order)
    valid = F.col("caseid").isNotNull() & F.col("age").between(0, 120)
    for name, low, high in (("height", 40, 250), ("weight", 2, 400)):
        if name in df.columns:
            valid = valid & (F.col(name).isNull() | F.col(name).between(low, high))
    good, bad = split_valid(df, valid, fv.PATIENT_REASON)
    if "sex" in good.columns:
        good = good.withColumn("sex", std_text("sex"))
    parts = split_columns(good, {"demographics": fv.DEMOGRAPHIC_COLUMNS, "surgery": fv.SURGERY_COLUMNS})
    return parts["demographics"], parts["surgery"], bad
