"""Collects queries and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from perispark.queries.fixtures import plain


class Registry:
    def __init__(self):
        self.queries, self.oracles = {}, {}

    def __call__(self, sql: str | None = None):
        """Register a function under its name, less a ``_query`` that keeps it apart from its operator."""

        def register(fn):
            name = fn.__name__.removesuffix("_query")
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = plain(sql)
            return fn

        return register


def rounded(df, *names, digits=6):
    """Doubles in ``digits`` places, as sums depend on the order they are added in."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def settled(df, *names, digits=4):
    """Means in ``digits`` places by way of nine, so that sums added in another order fall on the same side of a half."""
    return df.withColumns({n: F.round(F.round(n, 9), digits) for n in names})


def settle(expression: str, digits: int = 4) -> str:
    """The SQL that says the same as :func:`settled`."""
    return f"round(round({expression}, 9), {digits})"


def with_double_id(df, name="caseid"):
    """Ids that may be missing leave as doubles, as result checks read a nullable integer in different ways."""
    return df.withColumn(name, F.col(name).cast("double"))
