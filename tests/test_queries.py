"""Every query with SQL gives the same rows as that SQL on another engine."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_sql(spark, oracle, name):
    got = entry.queries()[name](spark, FOLDER)
    result = oracle.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(got.columns) == sorted(columns)
    expected = sorted((tuple(map(plain, r)) for r in result.fetchall()), key=repr)
    ours = sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=repr)
    assert ours == expected


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


def test_no_python_in_built_in_plans(spark):
    python = {"rich_map", "udf_length", "udtf_split", "udaf_avg", "top2_table_aggregate", "rolling_reduce", "window_user_fn"}
    for name, query in entry.queries().items():
        if name in python or name.startswith(("stream_", "skewed_")):
            continue
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
