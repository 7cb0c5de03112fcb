import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4, spark__driver__memory="4g", spark__default__parallelism="2")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Warehouse over the smallest test data."""
    from tradewind.testbed.registry import warehouse

    return warehouse(spark, SMALL)


@pytest.fixture
def frame(spark):
    """Small frame from a DDL string and rows."""
    return lambda ddl, rows: spark.createDataFrame(rows, ddl)


def rows(df, *columns):
    return sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()),
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
