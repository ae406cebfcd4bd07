"""Every registered query against its SQL on the smallest tables, and the shape of the ones without SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from affinis.plans.oracles import ORACLES as SQL
from affinis.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
ROWS_ONLY = {"model_predictions", "hybrid_predictions"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float) and math.isnan(x):
            return ""
        return f"{x:.6f}" if isinstance(x, float) else str(x)

    return sorted(columns), sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    result = database.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


def test_model_queries_predict_every_pair_within_the_scale(spark):
    pairs = QUERIES["cold_start_cells"](spark, FOLDER).count()
    for name in sorted(ROWS_ONLY):
        rows = QUERIES[name](spark, FOLDER).collect()
        assert len(rows) == pairs == len({(r.user_id, r.item_id) for r in rows})
        assert all(0.0 <= r.prediction <= 6.0 for r in rows)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "item_id", "prediction"] and df.count() > 0
