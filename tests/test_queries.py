"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from sparrowscope.plans.catalog import QUERIES
from sparrowscope.plans.oracle import ORACLE

DATA = Path("/root/testdata/sf0.001")
SQL = ORACLE
WITHOUT_SQL = {"account_clusters", "cluster_sizes", "cluster_silhouette", "k_sweep"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_catalogue():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    found = driver.queries()[name](spark, str(DATA))
    columns = sorted(found.columns)
    cursor = tables.execute(SQL[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = Counter(repr(tuple(row[i] for i in places)) for row in cursor.fetchall())
    rows = Counter(repr(tuple(row[column] for column in columns)) for row in found.collect())
    assert rows == expected


def test_entry(spark):
    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 150


def test_class_counts_at_the_larger_scale(spark):
    counts = driver.queries()["class_counts"](spark, "/root/testdata/sf0.01")
    assert dict(map(tuple, counts.collect())) == {
        "Business": 308, "KOL": 78, "bot": 5, "default_user": 5, "none": 1069, "project": 35,
    }


def test_clustering_queries(spark):
    sf_dir = "/root/testdata/sf0.01"
    sizes = driver.queries()["cluster_sizes"](spark, sf_dir).collect()
    assert sum(row["count"] for row in sizes) == 35 and len(sizes) == 3
    sweep = driver.queries()["k_sweep"](spark, sf_dir).collect()
    assert [row["k"] for row in sweep] == list(range(2, 10))
