"""Pairs of items that travel as bundles."""

import random

import pytest
from pyspark.sql import functions as F

import affinis as af
from affinis.operators import bundles, itemcf
from affinis.operators.staging import materialize
from tests.brute import Ratings

C = af.RatingColumns(user="u", item="i", stars="stars", order=("t",))


def numbered(seed, item=lambda j: j, users=25, items=20):
    draw = random.Random(seed)
    rows = [(u, item(j), draw.randint(1, 5)) for u in range(users) for j in draw.sample(range(items), 9)]
    return rows + [(999, item(j), draw.randint(1, 5)) for j in range(items - 3)]


def table(spark, rows):
    return spark.createDataFrame([(u, i, float(r), t) for t, (u, i, r) in enumerate(rows)], "u bigint, i bigint, stars double, t int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_shuffled_one_by_one(spark):
    found = af.item_similarity(table(spark, numbered(1)), None, C)
    shuffles = [x for x in plan(found).splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles and not any("a#" in x and "b#" in x for x in shuffles)


def test_rows_of_pairs_are_not_stored(spark, monkeypatch):
    stored, plain = [], itemcf.materialize
    monkeypatch.setattr(itemcf, "materialize", lambda df, name: stored.append((name, df.columns)) or plain(df, name))
    rows = numbered(2)
    truth, tests = Ratings(rows), [(u, i) for u in range(25) for i in range(20)]
    found = af.predict_item_cf(table(spark, rows), spark.createDataFrame(tests, "u bigint, i bigint"), C)
    assert {(r.u, r.i): r.prediction for r in found.collect()} == pytest.approx({p: truth.predict(*p) for p in tests}, abs=1e-9)
    assert not [x for x in stored if {"user", "item", "other"} <= set(x[1])]


@pytest.mark.parametrize("item", [lambda j: j, lambda j: 40_000 * j - 300_000, lambda j: (j - 9) << 58], ids=["small", "int", "bigint"])
@pytest.mark.parametrize("options", [{}, {"mode": "default_voting"}, {"heavy_profile": 6, "block": 4}], ids=str)
def test_items_of_any_size_dealt_over_parts(spark, monkeypatch, item, options):
    monkeypatch.setattr(itemcf, "HOT_BLOCKS", 1)
    rows = numbered(3, item)
    truth = Ratings(rows)
    found = af.item_similarity(table(spark, rows), None, C, **{"block": 30} | options).collect()
    mode = options.get("mode", "common")
    assert len(found) == len({(r.a, r.b) for r in found}) == sum(
        1 for a in truth.by_item for b in truth.by_item if a < b and truth.by_item[a].keys() & truth.by_item[b].keys())
    assert all(r.similarity == pytest.approx(truth.similarity(r.a, r.b, **({} if mode == "common" else {"mode": mode})), abs=1e-9) for r in found)


def test_predictions_with_hot_items_and_no_filter(spark, monkeypatch):
    monkeypatch.setattr(itemcf, "HOT_BLOCKS", 1)
    rows = numbered(4)
    truth, tests = Ratings(rows), [(u, i) for u in range(25) for i in range(20)]
    for full in (False, True):
        if full:
            monkeypatch.setattr(itemcf, "filter_of", lambda *args, **options: None)
        for k in (None, 2):
            found = af.predict_item_cf(table(spark, rows), spark.createDataFrame(tests, "u bigint, i bigint"), C, k=k, block=5)
            assert {(r.u, r.i): r.prediction for r in found.collect()} == pytest.approx(
                {p: truth.predict(*p, **({"k": k} if k else {})) for p in tests}, abs=1e-9)


def test_asked_pairs_of_unknown_items_and_other_types(spark):
    rows = numbered(5)
    truth = Ratings(rows)
    pairs = spark.createDataFrame([(1, 2), (2, 1), (3, 1 << 40), (4, 4), (7, None)], "x bigint, y bigint")
    found = af.item_similarity(table(spark, rows), pairs, C).collect()
    assert [(r.a, r.b) for r in found] == [(1, 2)]
    assert found[0].similarity == pytest.approx(truth.similarity(1, 2), abs=1e-12)


def test_narrowest_types(spark):
    rows = materialize(spark.createDataFrame([(127, -129, 1 << 31, "x", None), (-128, 5, 1, "y", None)],
                                             "a bigint, b bigint, c bigint, d string, e bigint"), "rows")
    found = bundles.narrowest(rows, ("a", "b", "c", "d", "e"))
    assert found == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "string", "e": "tinyint"}
    assert bundles.narrowest(rows.where(F.lit(False)), ("a",)) == {"a": "tinyint"}


def test_items_of_32_bits_travel_as_halves(spark):
    items = [-(1 << 31), -65_537, -32_769, -1, 0, 32_767, 32_768, 65_535, 65_536, (1 << 31) - 1]
    rows = spark.createDataFrame([(1, j, n % 5) for n, j in enumerate(items)], "user bigint, item bigint, rating bigint")
    kinds = bundles.narrowest(rows, ("item", "rating"))
    whole = {(x, y) for x in items for y in items if x < y}
    pairs = spark.createDataFrame([(x, y, 0, 0) for x, y in sorted(whole)], "a bigint, b bigint, rating_a bigint, rating_b bigint")
    lists = spark.createDataFrame([(1, items)], "user bigint, items array<int>")
    types = dict(rows.dtypes)
    for found, carry in ((bundles.profile_bundles(rows, ("rating",), kinds), ("rating",)), (bundles.single_bundles(pairs, ("rating",), kinds), ("rating",)),
                         (bundles.crossed_bundles(lists, lists, kinds["item"]), ())):
        assert dict(found.dtypes)["bs"] == dict(found.dtypes)["_high_bs"] == "array<smallint>"
        for load in (None, 4):
            loads = rows.select("item", F.lit(9.0).alias("load")) if load else None
            opened = bundles.unfolded(found, carry, types, 45.0, loads, load or 100).collect()
            assert {(r.a, r.b) for r in opened} == whole
            assert len(opened) == (len(whole) if carry else 2 * len(whole))
    rated = {(r.a, r.b): (r.rating_a, r.rating_b) for r in bundles.unfolded(
        bundles.profile_bundles(rows, ("rating",), kinds), ("rating",), types, 45.0, None, 100).collect()}
    assert rated == {(x, y): (items.index(x) % 5, items.index(y) % 5) for x, y in whole}


def test_hybrid_weight_reads_the_profiles_that_prediction_stored(spark, monkeypatch):
    from affinis.operators import hybrid

    train, tests = table(spark, numbered(6)), spark.createDataFrame([(u, i) for u in (1, 2, 999, 1000) for i in (1, 19)], "u bigint, i bigint")
    alone = sorted(map(tuple, af.hybrid_weight(train, tests, C).collect()))
    read, plain = [], hybrid.profile_sizes
    monkeypatch.setattr(hybrid, "profile_sizes", lambda rated: read.append(rated) or plain(rated))
    with af.shared_tables():
        assert sorted(map(tuple, af.hybrid_weight(train, tests, C).collect())) == alone and not read
        af.predict_item_cf(train, tests, C, distinct=True)
        found = sorted(map(tuple, af.hybrid_weight(train, tests, C).collect()))
    assert found == alone and len(read) == 1
