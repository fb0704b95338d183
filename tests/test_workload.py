"""Registered queries against their comparison SQL on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_comparison_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    rows = df.collect()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    theirs, names = cursor.fetchall(), [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(
        repr(tuple(r[i] for i in at)) for r in theirs)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[-1] == "cnt" and df.count() > 0


def test_stored_tables(spark):
    from workload.shapes import Warehouse

    tables = Warehouse(spark, SF_DIR).tables
    assert set(tables) == {"patient", "condition", "observation", "documentreference", "encounter"}
    documents = tables["documentreference"]
    assert documents.count() > 0 and documents.where("content IS NULL").count() == 0
    assert tables["observation"].where("modifierExtension IS NULL").count() > 0
    assert tables["observation"].where("size(modifierExtension) = 0").count() == 0
    # Identifiers differ in letter case between the reports' text and the tables.
    assert documents.select("CONTEXT.Encounter").count() == documents.count()
