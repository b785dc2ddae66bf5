"""Every registered query against its SQL in another engine, on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from zoneflow import oracle, queries as registered

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    found = contract.queries()[name](spark, sf_dir)
    names = sorted(found.columns)
    rows = sorted((tuple(r[c] for c in names) for r in found.collect()), key=repr)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    assert rows == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def test_every_query_without_sql_is_a_model_query():
    assert set(registered.queries()) - set(SQL) == {"train_forecast", "tune_demand"}
    assert set(SQL) <= set(contract.queries())


def test_entry_has_rows_and_a_stable_schema(spark, sf_dir):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and len(first.columns) == 75
    assert first.count() > 0
