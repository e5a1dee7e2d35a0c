"""Every registered query with SQL against DuckDB, by names, types and values."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def _sorted(rows):
    return sorted((tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    columns = sorted(df.columns)
    assert {f.name: SPARK_TO_DUCKDB[f.dataType.simpleString()] for f in df.schema} == types
    order = [list(types).index(c) for c in columns]
    expected = _sorted(tuple(r[i] for i in order) for r in result.fetchall())
    actual = _sorted(df.select(*[f"`{c}`" for c in columns]).collect())
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).count() == 1473


def test_trained_queries(spark):
    queries = entry.queries()
    for name in ("rf_cv", "gbt_cv"):
        (row,) = queries[name](spark, SF_DIR).collect()
        assert 0.6 <= row.cv_auc <= 1.0
    importance = queries["feature_importance"](spark, SF_DIR).orderBy("rank").collect()
    assert [r["rank"] for r in importance] == [1, 2, 3, 4, 5]
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    rows = queries["predictions"](spark, SF_DIR).collect()
    assert len(rows) == 71 and all(abs(r.prob_LGG + r.prob_HGG - 1) < 1e-5 for r in rows)
