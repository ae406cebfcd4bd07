import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import affinis as af
from affinis.operators import jaccard
from tests import brute

SCHEMA = "item bigint, member string"


def random_baskets(seed, items=60, members=40):
    draw = random.Random(seed)
    rows = []
    for item in range(items):
        size = draw.choice([1, 2, 3, 5, 8, 13])
        rows += [(item, f"m{draw.randrange(members)}") for _ in range(size)]  # repeats included
    for copy in range(items, items + 12):  # a group of equal sets
        rows += [(copy, m) for m in ("m1", "m2", "m3")]
    for copy in range(items + 12, items + 20):  # near copies, each with a member of its own
        rows += [(copy, m) for m in ("m4", "m5", "m6", f"own{copy}")]
    rows += [(item, "everywhere") for item in range(0, items, 2)]
    return rows


def pairs(df):
    return {(r.a, r.b): r.similarity for r in df.collect()}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7, 1.0])
def test_exact_pairs_match_brute_force(spark, threshold):
    rows = random_baskets(1)
    found = pairs(af.similar_items_exact(spark.createDataFrame(rows, SCHEMA), "item", "member", threshold))
    assert found == pytest.approx(brute.similar_pairs(rows, threshold))


@pytest.mark.parametrize("block,giant", [(3, 1_000_000), (20_000, 4), (2, 0)])
def test_exact_pairs_survive_hot_groups_and_giant_sets(spark, block, giant):
    rows = random_baskets(2)
    df = spark.createDataFrame(rows, SCHEMA)
    found = pairs(af.similar_items_exact(df, "item", "member", 0.4, block=block, giant=giant))
    assert found == pytest.approx(brute.similar_pairs(rows, 0.4))


@pytest.mark.parametrize("block,crowded,giant", [(20_000, 1_000, 1_000_000), (3, 3, 1_000_000), (20_000, 2, 4)])
def test_lsh_pairs_are_the_similar_pairs_that_share_a_bucket(spark, block, crowded, giant):
    rows = random_baskets(3)
    df = spark.createDataFrame(rows, SCHEMA)
    buckets = brute.bucket_pairs(rows, 12, 2)
    expected = {p: s for p, s in brute.similar_pairs(rows, 0.5).items() if p in buckets}
    found = pairs(af.similar_items_lsh(df, "item", "member", bands=12, rows=2, crowded=crowded, block=block,
                                       giant=giant))
    assert expected and found == pytest.approx(expected)


@pytest.mark.parametrize("block", [20_000, 3])
def test_candidates_are_all_pairs_that_share_a_bucket(spark, block):
    rows = random_baskets(4)
    df = spark.createDataFrame(rows, SCHEMA)
    found = af.lsh_candidates(df, "item", "member", bands=8, rows=3, block=block).collect()
    assert len(found) == len(set(found))
    sets = defaultdict(set)
    for name, member in rows:
        sets[name].add(member)
    least = {min(x for x in sets if sets[x] == held) for held in sets.values()}
    assert {(r.a, r.b) for r in found} == {p for p in brute.bucket_pairs(rows, 8, 3) if set(p) <= least}


def test_universal_hashes_find_the_copies(spark):
    rows = random_baskets(5)
    df = spark.createDataFrame(rows, SCHEMA)
    found = pairs(af.similar_items_lsh(df, "item", "member", hash="universal"))
    exact = brute.similar_pairs(rows, 0.5)
    assert set(found) <= set(exact)
    assert {p for p, s in exact.items() if s == 1.0} <= set(found)
    with pytest.raises(ValueError):
        af.similar_items_lsh(df, "item", "member", hash="other")


def test_one_member_in_a_third_of_all_rows(spark):
    draw = random.Random(6)
    rows = [(i, "hot") for i in range(400)] + [(i, f"m{draw.randrange(300)}") for i in range(400) for _ in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute.similar_pairs(rows, 0.6)
    assert pairs(af.similar_items_exact(df, "item", "member", 0.6, block=50)) == pytest.approx(expected)
    buckets = brute.bucket_pairs(rows, 10, 2)
    found = pairs(af.similar_items_lsh(df, "item", "member", 10, 2, 0.6, crowded=40, block=50))
    assert found == pytest.approx({p: s for p, s in expected.items() if p in buckets})


def test_a_third_of_all_items_are_copies(spark):
    rows = [(i, m) for i in range(100) for m in ("a", "b", "c")] + [(i, f"x{i % 70}") for i in range(100, 300)]
    rows += [(i, "d") for i in range(98, 100)]
    found = pairs(af.similar_items_exact(spark.createDataFrame(rows, SCHEMA), "item", "member", 0.7, block=10))
    assert found == pytest.approx(brute.similar_pairs(rows, 0.7))


def test_result_does_not_depend_on_partitions(spark):
    rows = random_baskets(7)
    results = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = spark.createDataFrame(rows, SCHEMA).repartition(n)
        results.append(sorted(af.lsh_bands(df, "item", "member", 6, 2).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_text_items_and_empty_input(spark):
    rows = [("b", "x"), ("a", "x"), ("c", "y"), (None, "x"), ("d", None)]
    df = spark.createDataFrame(rows, "item string, member string")
    assert pairs(af.similar_items_exact(df, "item", "member")) == {("a", "b"): 1.0}
    assert pairs(af.similar_items_lsh(df, "item", "member")) == {("a", "b"): 1.0}
    none = df.where("false")
    assert af.similar_items_exact(none, "item", "member").collect() == []
    assert af.similar_items_lsh(none, "item", "member").collect() == []


def test_precision_and_recall(spark):
    found = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "a int, b int")
    truth = spark.createDataFrame([(1, 2), (3, 4), (7, 8), (9, 10)], "a int, b int")
    row = af.pair_precision_recall(found, truth).first()
    assert (row.found, row.truth, row.hits, row.precision, row.recall) == (3, 4, 2, pytest.approx(2 / 3), 0.5)
    assert af.pair_precision_recall(found.where("false"), truth).first().precision is None


def test_compatible_sizes_keep_every_pair_at_the_threshold(spark):
    sizes = spark.createDataFrame([(a, b) for a in range(1, 60) for b in range(1, 60)], "n_a int, n_b int")
    for threshold in (0.3, 0.5, 0.7, 1.0):
        kept = {(r.n_a, r.n_b) for r in sizes.where(jaccard._compatible(threshold)).collect()}
        assert kept >= {(a, b) for a in range(1, 60) for b in range(1, 60) if min(a, b) / max(a, b) >= threshold}


@pytest.mark.parametrize("threshold, small, large", [(0.2, 59_039_439, 295_197_195), (0.55, 917_468_365, 1_668_124_300),
                                                     (0.1, 10**12, 10**13), (0.07, 7 * 10**11, 10**13)])
def test_thresholds_are_exact_for_sets_of_any_size(spark, threshold, small, large):
    """A subset whose similarity is exactly the threshold passes; one member less doesn't."""
    rows = spark.createDataFrame([(small, large, small), (small - 1, large, small - 1)], "n_a bigint, n_b bigint, common bigint")
    rows = rows.withColumns({"reach_a": F.col("common"), "reach_b": F.col("common"), "n": F.col("n_b"), "reach": F.col("common")})
    found = rows.select(jaccard._compatible(threshold), jaccard._reachable(threshold), jaccard._in_prefix(threshold)).collect()
    assert [tuple(r) for r in found] == [(True,) * 3, (False,) * 3]


def test_baskets_of_texts_hold_every_script_and_short_texts(spark, tmp_path):
    from affinis.plans.tables import shingles

    texts = [(1, "Été à Łódź, naïve!"), (2, "два слова"), (3, "日本語"), (4, "..."), (5, "")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r["item"], r.member) for r in shingles(spark, str(tmp_path)).collect()}
    assert found == {(1, "été à łódź"), (1, "à łódź naïve"), (2, "два слова"), (3, "日本語")}


def test_copies_come_as_families(spark):
    rows = [(i, m) for i in range(1, 6) for m in "abc"] + [(9, m) for m in "abcd"]
    df = spark.createDataFrame(rows, "item bigint, member string")
    for find in (af.similar_sets_exact, af.similar_sets_lsh):
        pairs, baskets = find(df, "item", "member")
        assert [tuple(r) for r in pairs.collect()] == [(1, 9, 0.75)]
        assert {tuple(r) for r in baskets.families().collect()} == {(1, i) for i in range(1, 6)} | {(9, 9)}


def test_stored_tables_go_with_their_scope(spark):
    import os

    from affinis.operators.staging import materialize

    with af.stored_tables(spark):
        path = materialize(spark.range(3), "scoped").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
