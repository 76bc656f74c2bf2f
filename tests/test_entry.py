"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from check_oracle import TABLES
from workload.queries import QUERIES

SF_DIR = __spark_entry__.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "events_time_bucket" and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    relation = duck.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin") if node in plan]

    def canonical(rows, names):
        order = [names.index(c) for c in columns]
        return sorted(tuple("~" if row[i] is None else str(row[i]) for i in order) for row in rows)

    assert canonical(df.collect(), df.columns) == canonical(relation.fetchall(), relation.columns)
