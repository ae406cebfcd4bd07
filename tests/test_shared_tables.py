"""Equal plans are stored once within a scope."""

import os

import pytest
from pyspark.sql import functions as F

import affinis as af
from affinis.operators import staging
from affinis.plans import tables
from affinis.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def written(monkeypatch):
    names, plain = [], staging.materialize

    def counted(df, name):
        names.append(name)
        return plain(df, name)

    monkeypatch.setattr(staging, "materialize", counted)
    return names


def test_equal_plans_are_stored_once(spark, written, tmp_path):
    spark.range(20).write.parquet(f"{tmp_path}/t")

    def plan(least):
        return spark.read.parquet(f"{tmp_path}/t").where(F.col("id") > least).select((F.col("id") * 2).alias("x"))

    with af.shared_tables():
        first, again, other = (staging.stored_once(plan(k), f"t{k}") for k in (3, 3, 4))
        with af.shared_tables():  # an inner scope sees the outer one's tables
            inner = staging.stored_once(plan(3), "t3")
            staging.stored_once(plan(5), "t5")
        staging.stored_once(plan(5), "t5")
    assert first.inputFiles() == again.inputFiles() == inner.inputFiles() != other.inputFiles()
    assert written == ["t3", "t4", "t5", "t5"]
    assert sorted(r.x for r in first.collect()) == list(range(8, 40, 2))  # still there
    staging.stored_once(plan(3), "outside")
    assert written[-1] == "outside"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", ["hybrid_predictions", "item_pair_similarity"])
def test_a_query_stores_split_and_ratings_once(spark, written, name):
    rows = QUERIES[name](spark, FOLDER).count()
    assert rows and written.count("split") == 1 and written.count("rated") == 1
    assert not staging.sharing() and tables.train(spark, FOLDER).count() > 0
