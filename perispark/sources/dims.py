"""Static dimension tables, built as local relations so the planner knows how small they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perispark import fixed_values as fv


def _local_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    def literal(v) -> str:
        return f"{v!r}D" if isinstance(v, float) else "'" + v.replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def sensors_metadata(spark: SparkSession, sensors=None) -> DataFrame:
    """The sensor dimension; ``sensors`` gives rows (sensor, parameter, brand, unit) of one's own."""
    return _local_table(spark, sensors or fv.SENSORS, ["sensor_id", "parameter_measured", "equipment_brand", "unit_of_measure"])


def lab_limits(spark: SparkSession) -> DataFrame:
    return _local_table(spark, fv.LAB_LIMITS, ["name", "min_normal", "max_normal", "unit"])
