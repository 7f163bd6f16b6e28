import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from perispark.session import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples in the order of all (or the named) columns, nulls first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda t: [(x is not None, str(type(x)), x) for x in t])
