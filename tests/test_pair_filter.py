"""The filter of wanted pairs, the choice between pairing and looking up, and number types."""

import logging
import random

import pytest
from pyspark.sql import functions as F

import affinis as af
from affinis.operators import itemcf, pairfilter
from affinis.operators.staging import materialize
from affinis.operators.stats import RatingColumns, pair_ratings

C = RatingColumns()


def rating_rows(seed, users=40, items=60, most=25):
    draw = random.Random(seed)
    rows = [(f"u{u}", f"i{i}", float(draw.randint(1, 5))) for u in range(users) for i in draw.sample(range(items), draw.randint(1, most))]
    return rows + [("heavy", f"i{i}", float(1 + i % 5)) for i in range(items)]


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id string, business_id string, stars double")


@pytest.mark.parametrize("n, bits", [(1, 24), (500, 24), (5000, 8)])
def test_no_key_is_lost_and_few_others_pass(spark, n, bits):
    keys = materialize(spark.range(n).select((F.col("id") * 7).alias("a"), F.concat(F.lit("x"), "id").alias("b")), "keys")
    found = pairfilter.filter_of(keys, "a", "b", bits=bits)
    assert found.keep(keys, "a", "b").count() == n
    others = spark.range(20_000).select((F.col("id") * 7 + 1).alias("a"), F.concat(F.lit("x"), "id").alias("b"))
    assert found.keep(others, "a", "b").count() < (60 if bits == 24 else 2500)
    assert found.blocks.agg(F.min(F.size("_words")), F.max(F.size("_words"))).first() == (pairfilter.WORDS, pairfilter.WORDS)


def test_a_filter_never_exceeds_its_bytes(spark):
    keys = materialize(spark.range(20_000), "keys")
    assert pairfilter.filter_of(keys, "id", most_bytes=4096) is None  # 1.6 bits a key would let most rows pass
    small = pairfilter.filter_of(keys, "id", most_bytes=20_000)
    assert small.number * pairfilter.WORDS * 8 <= 20_000 and small.keep(keys, "id").count() == 20_000
    assert pairfilter.filter_of(keys.limit(0), "id").keep(keys, "id").count() == 0


def test_rows_that_reach_the_shuffle_are_few_more_than_needed(spark):
    rated = materialize(pair_ratings(ratings(spark, rating_rows(1, 400, 300, 60)), C), "rated")
    wanted = materialize(spark.createDataFrame([(f"i{a}", f"i{b}") for a in range(40) for b in range(300) if f"i{a}" < f"i{b}"],
                                               "a string, b string"), "wanted")
    every = itemcf.co_rated_rows(rated, None)
    needed = every.join(wanted, ["a", "b"], "left_semi").count()
    kept = pairfilter.filter_of(wanted, "a", "b").keep(every, "a", "b").count()
    assert needed <= kept <= 1.2 * needed < every.count()


@pytest.mark.parametrize("cost", [0.0, 1e-3, 1.0, 1e12])
def test_pairing_and_looking_up_give_the_same_rows(spark, cost, caplog):
    rated = materialize(pair_ratings(ratings(spark, rating_rows(2)), C), "rated")
    wanted = materialize(spark.createDataFrame([(f"i{a}", f"i{b}") for a in range(0, 60, 3) for b in range(60) if f"i{a}" < f"i{b}"],
                                               "a string, b string"), "wanted")
    expected = sorted(itemcf.co_rated_rows(rated, None).join(wanted, ["a", "b"], "left_semi").collect())
    with caplog.at_level(logging.INFO, logger="affinis.operators.itemcf"):
        found = sorted(itemcf.co_rated_rows(rated, wanted, lookup_cost=cost, heavy_profile=10, block=7).collect())
    assert found == expected
    # a profile of one item makes no rows by either way
    ways = {r.getMessage().rpartition(": ")[2] for r in caplog.records if " 0 rows by pairing" not in r.getMessage()}
    assert ways == ({"looked up"} if cost < 1e-2 else {"paired"} if cost > 1e9 else ways) and ways


def test_each_class_takes_the_way_of_fewer_rows(spark):
    # one long profile and many short ones; few pairs are asked for
    rows = [("long", f"i{i}", 3.0) for i in range(300)] + [(f"u{u}", f"i{i}", 4.0) for u in range(50) for i in (u, u + 1)]
    rated = materialize(pair_ratings(ratings(spark, rows), C), "rated")
    wanted = materialize(spark.createDataFrame([(f"i{i}", f"i{i + 1}") for i in range(1, 9)], "a string, b string"), "wanted")
    light = rated.select("user", "item", "rating")
    profiles = light.groupBy("user").agg(F.count(F.lit(1)).alias("_size"))
    classes, made = itemcf._looked_up_classes(light, profiles, wanted, 4.0)
    assert classes == [8] and made == 50


@pytest.mark.parametrize("mode", ["common", "default_voting"])
def test_pairs_of_all_number_types_are_kept(spark, mode, monkeypatch):
    data = ratings(spark, rating_rows(3, 25, 20, 12))
    plain = {(r.a, r.b): (r.similarity, r.n_common) for r in af.item_similarity(data, None, C, mode=mode).collect()}
    # so low a bound parts the pairs into both types
    import affinis.functions.similarity as similarity

    bound = 4 * 25 * 8.0 ** 3 if mode == "common" else 12 * 25 * 8.0 ** 5
    monkeypatch.setattr(similarity, "BIGINT_BOUND", bound)
    assert not similarity.fits_in_bigint(mode, 5, 8)
    parted = {(r.a, r.b): (r.similarity, r.n_common) for r in af.item_similarity(data, None, C, mode=mode).collect()}
    assert parted.keys() == plain.keys()
    assert all(parted[k] == pytest.approx(plain[k]) for k in plain)
