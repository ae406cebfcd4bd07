import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import affinis as af
from affinis.functions.similarity import exact_terms, pearson_quotient
from affinis.operators import itemcf
from affinis.operators.itemcf import repeat_rows
from tests.brute import Ratings

C = af.RatingColumns(user="u", item="i", stars="stars", order=("t",))


def table(spark, rows):
    """Later rows are later ratings."""
    return spark.createDataFrame([(u, i, float(r), t) for t, (u, i, r) in enumerate(rows)],
                                 "u string, i string, stars double, t int")


def asked(spark, pairs):
    return spark.createDataFrame(pairs, "u string, i string")


def predictions(df):
    return {(r.u, r.i): r.prediction for r in df.collect()}


def random_ratings(seed, users=25, items=20, rows=220):
    draw = random.Random(seed)
    data = [(f"u{draw.randrange(users):02d}", f"i{draw.randrange(items):02d}", draw.randint(1, 5))
            for _ in range(rows)]
    data += [("busy", f"i{j:02d}", draw.randint(1, 5)) for j in range(items - 4)]
    tests = [(f"u{draw.randrange(users + 3):02d}", f"i{draw.randrange(items + 2):02d}") for _ in range(80)]
    tests += [("busy", f"i{j:02d}") for j in range(items)]
    return data, tests


OPTIONS = [{}, {"rho": 6.0}, {"k": 3}, {"mode": "default_voting"}, {"min_common": 3}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_predictions_match_brute_force(spark, options):
    data, tests = random_ratings(1)
    truth = Ratings(data)
    found = predictions(af.predict_item_cf(table(spark, data), asked(spark, tests), C, **options))
    assert found == pytest.approx({p: truth.predict(*p, **options) for p in tests}, abs=1e-9)


@pytest.mark.parametrize("options", [{}, {"mode": "default_voting"}], ids=str)
def test_heavy_users_and_small_blocks_change_nothing(spark, options):
    data, tests = random_ratings(2)
    truth = Ratings(data)
    found = predictions(af.predict_item_cf(table(spark, data), asked(spark, tests), C, heavy_profile=6, block=4,
                                           **options))
    assert found == pytest.approx({p: truth.predict(*p, **options) for p in tests}, abs=1e-9)


def test_few_asked_items_use_only_their_pairs(spark):
    data, _ = random_ratings(3)
    truth = Ratings(data)
    tests = [(f"u{j:02d}", item) for j in range(20) for item in ("i03", "i07")]
    found = predictions(af.predict_item_cf(table(spark, data), asked(spark, tests), C))
    assert found == pytest.approx({p: truth.predict(*p) for p in tests}, abs=1e-9)


def test_similarity_of_all_co_rated_pairs(spark):
    data, _ = random_ratings(4)
    truth = Ratings(data)
    for options in ({}, {"heavy_profile": 5, "block": 3}):
        found = af.item_similarity(table(spark, data), None, C, **options).collect()
        expected = {(a, b): truth.similarity(a, b) for a in truth.by_item for b in truth.by_item
                    if a < b and truth.by_item[a].keys() & truth.by_item[b].keys()}
        assert {(r.a, r.b): r.similarity for r in found} == pytest.approx(expected, abs=1e-12)
        assert all(-1 - 1e-12 <= r.similarity <= 1 + 1e-12 for r in found)


def test_similarity_of_asked_pairs_in_any_order(spark):
    data, _ = random_ratings(5)
    truth = Ratings(data)
    pairs = spark.createDataFrame([("i03", "i01"), ("i01", "i03"), ("i02", "i02"), ("i04", "i09")], "x string, y string")
    found = {(r.a, r.b): r.similarity for r in af.item_similarity(table(spark, data), pairs, C).collect()}
    assert found == pytest.approx({p: truth.similarity(*p) for p in (("i01", "i03"), ("i04", "i09"))})


HAND = [("a", "x", 5), ("a", "y", 3), ("b", "x", 4), ("b", "y", 2), ("c", "z", 1), ("c", "w", 3)]


@pytest.mark.parametrize("pair,expected", [
    (("new", "x"), 4.5),      # cold user: the item's average
    (("a", "new"), 4.0),      # cold item: the user's average
    (("new", "new2"), 2.5),   # both cold
    (("a", "x"), 5.0),        # rated before
])
def test_cold_start_and_known_pairs(spark, pair, expected):
    assert predictions(af.predict_item_cf(table(spark, HAND), asked(spark, [pair]), C)) == {pair: expected}


def test_cells(spark):
    pairs = [("new", "x"), ("a", "new"), ("new", "new2"), ("a", "x"), ("a", "z")]
    cells = [r.cell for p in pairs for r in af.cold_start_cells(table(spark, HAND), asked(spark, [p]), C).collect()]
    assert cells == ["cold_user", "cold_item", "both_cold", "already_rated", "both_known"]


def test_no_common_user_uses_the_ratio_of_averages(spark):
    pairs = spark.createDataFrame([("x", "z"), ("x", "y")], "p string, q string")
    found = {(r.a, r.b): (r.similarity, r.n_common)
             for r in af.item_similarity(table(spark, HAND), pairs, C).collect()}
    assert found["x", "z"] == (pytest.approx(1 / 4.5), 0)
    assert found["x", "y"] == (pytest.approx(1.0), 2)


def test_zero_numerator_and_fallback(spark):
    # every common user of p and q gives q its average, so the similarity is 0 and no neighbour counts
    rows = [("a", "p", 5), ("a", "q", 3), ("b", "p", 1), ("b", "q", 3), ("c", "q", 3)]
    found = predictions(af.predict_item_cf(table(spark, rows), asked(spark, [("c", "p")]), C))
    assert found == {("c", "p"): 3.0}


def test_negative_neighbours_are_left_out(spark):
    rows = [("a", "p", 5), ("a", "q", 1), ("b", "p", 1), ("b", "q", 5), ("c", "q", 2), ("c", "s", 4)]
    truth = Ratings(rows)
    assert truth.similarity("p", "q") < 0
    found = predictions(af.predict_item_cf(table(spark, rows), asked(spark, [("c", "p")]), C))
    assert found["c", "p"] == pytest.approx(4.0)


def test_latest_rating_counts_once_but_averages_take_all_rows(spark):
    rows = [("a", "x", 1), ("a", "x", 5), ("b", "x", 3)]
    df = table(spark, rows)
    assert {(r.u, r.i): r.stars for r in af.latest_ratings(df, C).collect()} == {("a", "x"): 5.0, ("b", "x"): 3.0}
    stats = af.item_stats(df, C).first()
    assert (stats.rating_sum, stats.rating_count, stats.rating_avg, stats.raters) == (9.0, 3, 3.0, 2)
    assert predictions(af.predict_item_cf(df, asked(spark, [("a", "x")]), C)) == {("a", "x"): 5.0}


def test_every_test_row_gets_a_prediction(spark):
    pairs = [("a", "z")] * 3 + [("new", "x")] * 2
    df = af.predict_item_cf(table(spark, HAND), asked(spark, pairs), C)
    assert df.count() == 5
    assert af.predict_item_cf(table(spark, HAND), asked(spark, pairs), C, distinct=True).count() == 2


def test_repeated_rows_are_expanded_in_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 25)], "x string, copies bigint")
    for chunk in (10, 1000):
        rows = repeat_rows(df, 25, chunk)
        assert rows.columns == ["x"]
        assert {r.x: r["count"] for r in rows.groupBy("x").count().collect()} == {"a": 1, "b": 10, "c": 11, "d": 25}


def test_options(spark):
    data, tests = random_ratings(6)
    df, pairs = table(spark, data), asked(spark, tests)
    plain = predictions(af.predict_item_cf(df, pairs, C))
    scaled = predictions(af.predict_item_cf(df, pairs, C, rescale=True))
    lo, hi = min(plain.values()), max(plain.values())
    assert scaled == pytest.approx({p: (v - lo) / (hi - lo) * 4 + 1 for p, v in plain.items()})
    whole = predictions(af.predict_item_cf(df, pairs, C, round_to=0))
    assert all(v == round(v) and abs(v - plain[p]) <= 0.5 for p, v in whole.items())
    cold = predictions(af.predict_item_cf(df, pairs, C, cold="default"))
    truth = Ratings(data)
    assert all(v == (plain[u, i] if u in truth.by_user and i in truth.by_item else 2.5) for (u, i), v in cold.items())
    for bad in ({"cold": "x"}, {"mode": "x"}):
        with pytest.raises(ValueError):
            af.predict_item_cf(df, pairs, C, **bad)


def test_half_stars(spark):
    data, tests = random_ratings(7)
    halves = af.RatingColumns(user="u", item="i", stars="stars", order=("t",), unit=0.5)
    rows = [(u, i, r / 2) for u, i, r in data]
    found = predictions(af.predict_item_cf(table(spark, rows), asked(spark, tests), halves, default=1.25))
    truth = Ratings(data)
    assert found == pytest.approx({p: truth.predict(*p) / 2 for p in tests}, abs=1e-9)
    with pytest.raises(Exception, match="not a multiple"):
        af.predict_item_cf(table(spark, rows), asked(spark, tests), C).collect()


def pair_row(spark, **values):
    names = ("total", "rows", "sum", "squares", "all_sum", "all_squares", "raters")
    row = {f"{x}_{side}": values[f"{x}_{side}"] for x in names for side in "ab"}
    row |= {"n_common": values["n_common"], "products": values["products"]}
    return spark.createDataFrame([row], ", ".join(f"{x} bigint" for x in row))


def exact_similarity(v, mode):
    """From the definition, in fractions: groups of raters that gave the same stars."""
    mean = {x: Fraction(v[f"total_{x}"], v[f"rows_{x}"]) for x in "ab"}
    vote = {x: Fraction(v[f"sum_{x}"], v["n_common"]) for x in "ab"}
    top = v["products"] - mean["a"] * v["sum_b"] - mean["b"] * v["sum_a"] + v["n_common"] * mean["a"] * mean["b"]
    norm = {x: v[f"squares_{x}"] - 2 * mean[x] * v[f"sum_{x}"] + v["n_common"] * mean[x] ** 2 for x in "ab"}
    if mode == "default_voting":
        for x, y in ("ab", "ba"):
            only = v[f"raters_{x}"] - v["n_common"]
            top += (v[f"all_sum_{x}"] - v[f"sum_{x}"] - only * mean[x]) * (vote[y] - mean[y])
            norm[x] += (v[f"all_squares_{x}"] - v[f"squares_{x}"] - 2 * mean[x] * (v[f"all_sum_{x}"] - v[f"sum_{x}"])
                        + only * mean[x] ** 2)
            norm[y] += only * (vote[y] - mean[y]) ** 2
    return float(top) / math.sqrt(norm["a"]) / math.sqrt(norm["b"])


@pytest.mark.parametrize("raters", [40, 100_000, 50_000_000, 1_000_000_000])
@pytest.mark.parametrize("mode", ["common", "default_voting"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_terms_hold_items_of_any_number_of_ratings(spark, raters, mode, ansi):
    """Each item has ``raters`` raters, half of them common: fives and ones, and a quarter of the common ones disagree."""
    n, common = raters, raters // 2
    agree, differ = common * 3 // 4, common - common * 3 // 4
    fives_a, fives_b = agree // 2 + differ, agree // 2
    ones_a, ones_b = common - fives_a, common - fives_b
    v = {"n_common": common, "products": (agree // 2) * 25 + differ * 5 + (common - agree // 2 - differ)}
    for x, fives, ones in (("a", fives_a, ones_a), ("b", fives_b, ones_b)):
        v |= {f"sum_{x}": 5 * fives + ones, f"squares_{x}": 25 * fives + ones}
        rest = n - common  # all threes
        v |= {f"all_sum_{x}": v[f"sum_{x}"] + 3 * rest, f"all_squares_{x}": v[f"squares_{x}"] + 9 * rest,
              f"raters_{x}": n, f"rows_{x}": n, f"total_{x}": v[f"sum_{x}"] + 3 * rest}
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = pair_row(spark, **v).withColumns({f"_{k}": F.expr(sql) for k, sql in exact_terms(mode, 5).items()})
        found = row.select(pearson_quotient(F.col("_top"), F.col("_norm_a"), F.col("_norm_b"))).first()[0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert found == pytest.approx(exact_similarity(v, mode), rel=1e-9)


def test_only_rows_of_wanted_pairs_are_summed(spark):
    data, _ = random_ratings(5)
    rated = itemcf.materialize(itemcf.pair_ratings(table(spark, data), C), "rated")
    wanted = itemcf.materialize(spark.createDataFrame([("i00", "i01"), ("i02", "i05")], "a string, b string"), "wanted")
    every = itemcf.co_rated_rows(rated, None).collect()
    for heavy in (2_000, 3):  # by profile, and with most profiles heavy
        rows = itemcf.co_rated_rows(rated, wanted, heavy).collect()
        assert sorted(rows) == sorted(r for r in every if (r.a, r.b) in {("i00", "i01"), ("i02", "i05")})


def test_result_does_not_depend_on_partitions(spark):
    data, tests = random_ratings(8)
    results = []
    for n in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = table(spark, data).repartition(n)
        results.append(predictions(af.predict_item_cf(df, asked(spark, tests), C)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == pytest.approx(results[1], abs=1e-12)
