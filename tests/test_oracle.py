"""Every registered query against its SQL, on the smallest test data."""

import duckdb
import pytest

from compare import TABLES, rows_of
from conftest import SMALL
from tradewind.testbed.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


# Slow, and built from parts that other queries or tests cover; compare.py runs them too.
SLOW = {"rebuild_model", "scan_catalog", "write_clean", "stage_verify", "decision_log", "reconcile_report"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SMALL)
    result = database.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())
