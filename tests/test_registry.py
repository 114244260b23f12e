"""Every registered query against its SQL in another engine."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

# Queries over the corpus, if there, are checked by the tests of their own folder.
OF_CORPUS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in registry.queries().items() if not OF_CORPUS.match(n)}
ORACLES = {n: q for n, q in registry.oracle_sql().items() if not OF_CORPUS.match(n)}
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, engine, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect())
    result = engine.sql(ORACLES[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    theirs = sorted(tuple(comparable(r[i]) for i in order) for r in result.fetchall())
    assert ours == theirs
    assert ours


def test_nested_report_has_both_tables(spark, sf_dir):
    rows = registry._reports_apart(spark, sf_dir).collect()
    assert [r.table_name for r in rows] == ["raw_data", "cleaned_data"]


def test_entry(spark):
    assert registry.entry(spark).count() == 5
