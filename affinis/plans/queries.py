"""Every query by name: a function of the session and the folder of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import affinis as af
from affinis.operators.features import COMPLIMENT_FEATURES, USER_FEATURES
from affinis.operators.staging import materialize, staging_root
from affinis.plans import tables as t
from affinis.sources.ratings import RATINGS

C = t.COLUMNS
Query = Callable[[SparkSession, str], DataFrame]
TREES = {"trees": 20, "depth": 3}
#: one split of one feature, which SQL can find too
STUMP = {"trees": 1, "depth": 1, "step": 1.0}
#: several rounds of them over two features
STUMPS = {"trees": 5, "depth": 1, "step": 0.3}
BOOSTED = ("user_min", "business_avg_stars")
UNIVERSAL = 12


def shared(query: Query) -> Query:
    """The query with tables that its parts have in common stored once."""
    def run(spark, folder):
        with af.shared_tables():
            return query(spark, folder)

    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({x: F.round(x, 6) for x in columns})


def ratings_latest(spark, folder):
    return af.latest_ratings(t.ratings(spark, folder), C)


def item_stats(spark, folder):
    return rounded(af.item_stats(t.train(spark, folder), C), "rating_avg")


def user_stats(spark, folder):
    return rounded(af.user_stats(t.train(spark, folder), C), "rating_avg")


def split_train_test(spark, folder):
    shares = {"train": 0.6, "validation": 0.2, "test": 0.2}
    return af.split_ratings(t.ratings(spark, folder), ["user_id", "item_id"], shares, seed=1)


def prepared_ratings(spark, folder):
    parts = t.table(spark, folder, "part").withColumnRenamed("p_partkey", "item_id")
    return af.prepare_ratings(t.ratings(spark, folder), parts, F.col("p_type") == "ECONOMY", "item_id",
                              ("user_id", "item_id", "stars"))


def cold_start_cells(spark, folder):
    return af.cold_start_cells(t.train(spark, folder), t.test(spark, folder), C)


def user_codes(spark, folder):
    return af.member_codes(t.train(spark, folder), "user_id")


def minhash_signatures(spark, folder):
    signatures = af.minhash_signatures(t.shingles(spark, folder), "item", "member")
    return signatures.withColumn("h", F.col("h").cast("bigint"))


def lsh_universal(spark, folder):
    signatures = af.minhash_signatures(t.shingles(spark, folder), "item", "member", hashes=UNIVERSAL, hash="universal")
    return signatures.withColumn("h", F.col("h").cast("bigint"))


def lsh_bands(spark, folder):
    bands = af.lsh_bands(t.shingles(spark, folder), "item", "member")
    return bands.withColumn("band", F.col("band").cast("bigint"))


def lsh_candidates(spark, folder):
    return af.lsh_candidates(t.shingles(spark, folder), "item", "member")


def similar_items_lsh(spark, folder):
    return rounded(af.similar_items_lsh(t.shingles(spark, folder), "item", "member"), "similarity")


def similar_items_exact(spark, folder):
    return rounded(af.similar_items_exact(t.shingles(spark, folder), "item", "member"), "similarity")


def _set_pairs(pairs, baskets):
    return rounded(pairs, "similarity").withColumnsRenamed({"item_a": "a", "item_b": "b"})


def similar_sets_lsh(spark, folder):
    return _set_pairs(*af.similar_sets_lsh(t.shingles(spark, folder), "item", "member"))


def similar_sets_exact(spark, folder):
    return _set_pairs(*af.similar_sets_exact(t.shingles(spark, folder), "item", "member"))


def similar_items_lookup(spark, folder):
    """Similar items of the labelled documents, out of the folded relation."""
    relation = af.similar_items(t.shingles(spark, folder), "item", "member")
    return rounded(relation.of(t.table(spark, folder, "labels").select("doc_id")), "similarity")


def set_families(spark, folder):
    return af.set_families(t.shingles(spark, folder), "item", "member")


def similar_items_by_raters(spark, folder):
    pairs = af.similar_items_exact(t.train(spark, folder), "item_id", "user_id", threshold=0.08)
    return rounded(pairs, "similarity")


def lsh_precision_recall(spark, folder):
    baskets = t.shingles(spark, folder)
    found = af.similar_items_lsh(baskets, "item", "member")
    truth = af.similar_items_exact(baskets, "item", "member")
    return rounded(af.pair_precision_recall(found, truth), "precision", "recall")


def item_pair_similarity(spark, folder, **options):
    pairs = af.item_similarity(t.train(spark, folder), t.needed_pairs(spark, folder), C, **options)
    return rounded(pairs, "similarity")


def item_cf(**options) -> Query:
    def run(spark, folder):
        return rounded(af.predict_item_cf(t.train(spark, folder), t.test(spark, folder), C, **options), "prediction")

    return shared(run)


def co_rated_similarity(spark, folder):
    return rounded(af.item_similarity(t.train(spark, folder), None, C), "similarity")


def item_cf_half_stars(spark, folder):
    halves = af.RatingColumns(C.user, C.item, C.stars, C.order, unit=0.5)
    train = t.train(spark, folder).withColumn("stars", F.col("stars") / 2)
    return rounded(af.predict_item_cf(train, t.test(spark, folder), halves, rho=2.5, default=1.25, cap=2.5), "prediction")


def item_cf_repeated_rows(spark, folder):
    train, test = t.train_and_test_rows(spark, folder)
    return rounded(af.predict_item_cf(train, test, C, rho=2.5), "prediction")


def user_rating_stats(spark, folder, **options):
    stats = af.user_rating_stats(t.train(spark, folder), t.users(spark, folder), t.items(spark, folder), C, **options)
    return rounded(stats, "user_variance")


def user_sample_variance(spark, folder):
    return user_rating_stats(spark, folder, variance="sample")


def label_encode(spark, folder):
    def labels(rows):
        return rows.select(F.concat(F.lit("u"), "user_id").alias("user_label"),
                           F.concat(F.lit("i"), "item_id").alias("item_label"), "stars")

    train, test = labels(t.train(spark, folder)), labels(t.test(spark, folder))
    train, test = af.label_encode(train, ["user_label", "item_label"], test)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


class _Inputs:
    """The tables of a model query, stored once because several steps read each of them."""

    def __init__(self, spark, folder, users):
        self.train = materialize(t.train(spark, folder).select(*C.pair, "stars", *C.order), "train")
        self.test = materialize(t.test(spark, folder), "test")
        self.users = materialize(users(spark, folder), "users")
        self.items = materialize(t.items(spark, folder), "items")

    def model_features(self, rows, how):
        stats = af.user_rating_stats(self.train, self.users, self.items, C)
        return af.build_features(rows, self.users, self.items, stats, how, C)

    def hybrid_features(self, rows, how):
        names = tuple(x for x in af.HYBRID_FEATURES if not x.startswith("business_"))
        return af.build_features(rows, self.users, self.items, None, how, C, names)


def train_features(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    return rounded(inputs.model_features(inputs.train.select(*C.pair, "stars"), "inner"), "user_variance")


def test_features(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    return rounded(inputs.model_features(inputs.test.select(*C.pair), "left"), "user_variance")


def hybrid_features(spark, folder):
    inputs = _Inputs(spark, folder, t.hybrid_users)
    return inputs.hybrid_features(inputs.test.select(*C.pair), "left")


def hybrid_train_features(spark, folder):
    inputs = _Inputs(spark, folder, t.hybrid_users)
    return inputs.hybrid_features(inputs.train.select(*C.pair, "stars"), "inner")


def feature_vectors(spark, folder):
    vectors = af.feature_matrix(test_features(spark, folder), af.MODEL_FEATURES)
    values = F.posexplode(vector_to_array("features")).alias("place", "value")
    return vectors.select(*C.pair, values).withColumn("place", F.col("place").cast("bigint"))


def features_with_extra(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    return af.build_features(inputs.test.select(*C.pair), inputs.users, inputs.items, None, "left", C,
                             extra=t.tips(spark, folder), extra_features=("tips", "likes"))


def features_numeric_text(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    users = inputs.users.withColumn("postal_code", F.concat(
        F.when(F.col("user_id") % 7 == 0, F.lit("N")).otherwise(F.lit("0")), F.col("user_id").cast("string")))
    return af.build_features(inputs.test.select(*C.pair), users, inputs.items, None, "left", C,
                             (*USER_FEATURES, "postal_code"), numeric_text=("postal_code",))


def model_stump(spark, folder):
    inputs, names = _Inputs(spark, folder, t.users), ("user_min",)
    model = af.fit_model(inputs.model_features(inputs.train.select(*C.pair, "stars"), "inner"), names, C, **STUMP)
    scored = af.predict_model(model, inputs.model_features(inputs.test.select(*C.pair), "left"), names, C)
    return rounded(scored, "prediction")


def model_boosted_stumps(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    model = af.fit_model(inputs.model_features(inputs.train.select(*C.pair, "stars"), "inner"), BOOSTED, C, **STUMPS)
    scored = af.predict_model(model, inputs.model_features(inputs.test.select(*C.pair), "left"), BOOSTED, C)
    return rounded(scored, "prediction")


def hybrid_stump(spark, folder):
    inputs, names = _Inputs(spark, folder, t.hybrid_users), ("business_avg_stars",)
    train, test = inputs.train, inputs.test
    model = af.fit_model(inputs.hybrid_features(train.select(*C.pair, "stars"), "inner"), names, C, **STUMP)
    scored = af.predict_model(model, inputs.hybrid_features(test.select(*C.pair), "left"), names, C)
    cf = af.predict_item_cf(train, test, C, rho=6.0, distinct=True)
    return rounded(af.predict_hybrid(cf, scored, af.hybrid_weight(train, test, C), C), "prediction")


def _new_path(spark, name):
    return f"{staging_root(spark)}/affinis/{name}-{uuid.uuid4().hex}"


def ratings_csv(spark, folder):
    path = _new_path(spark, "ratings")
    af.write_ratings(t.train(spark, folder).select("user_id", "item_id", "stars"), path)
    return af.read_ratings(spark, path)


def ratings_quarantine(spark, folder):
    path = _new_path(spark, "rating-lines")
    t.rating_lines(spark, folder).write.text(path)
    good, bad = af.read_checked(spark, path, RATINGS, header=False)
    return good.withColumns({"line": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")}).unionByName(
        bad.drop("file"), allowMissingColumns=True)


def item_profiles_json(spark, folder):
    path = _new_path(spark, "item-profiles")
    items = t.items(spark, folder).withColumn("business_id", F.col("item_id").cast("string"))
    items.select("business_id", "stars", "review_count", F.lit("x").alias("unused")).write.json(path)
    return af.read_item_profiles(spark, path)


def profiles_json(spark, folder):
    path = _new_path(spark, "profiles")
    t.hybrid_users(spark, folder).withColumn("user_id", F.col("user_id").cast("string")).write.json(path)
    return af.read_user_profiles(spark, path, USER_FEATURES + COMPLIMENT_FEATURES[:2])


def pairs_sink(spark, folder):
    path = _new_path(spark, "pairs")
    af.write_pairs(similar_sets_exact(spark, folder).select("a", "b", "similarity"), path)
    return af.read_similar_pairs(spark, path)


def predictions_sink(spark, folder):
    path = _new_path(spark, "predictions")
    af.write_predictions(item_cf(rho=2.5)(spark, folder).select("user_id", "item_id", "prediction"), path)
    return af.read_predictions(spark, path)


def model_predictions(spark, folder):
    inputs = _Inputs(spark, folder, t.users)
    train = inputs.model_features(inputs.train.select(*C.pair, "stars"), "inner")
    model = af.fit_model(train, af.MODEL_FEATURES, C, **TREES)
    return af.predict_model(model, inputs.model_features(inputs.test.select(*C.pair), "left"), af.MODEL_FEATURES, C)


def hybrid_weight(spark, folder, **options):
    weight = af.hybrid_weight(t.train(spark, folder), t.test(spark, folder), C, **options)
    return rounded(weight, "alpha").drop("copies")


def hybrid_weight_lifted(spark, folder):
    return hybrid_weight(spark, folder, rule=af.lifted_weight)


def hybrid_cf_useravg(spark, folder):
    train, test = t.train(spark, folder), t.test(spark, folder)
    cf = af.predict_item_cf(train, test, C, rho=6.0, distinct=True)
    averages = af.user_stats(train, C).select("user_id", "rating_avg")
    model = test.join(averages, "user_id", "left").select(
        *C.pair, F.coalesce("rating_avg", F.lit(2.5)).alias("prediction"))
    return rounded(af.predict_hybrid(cf, model, af.hybrid_weight(train, test, C), C), "prediction")


def hybrid_predictions(spark, folder):
    inputs = _Inputs(spark, folder, t.hybrid_users)
    train, test = inputs.train, inputs.test
    cf = af.predict_item_cf(train, test, C, rho=6.0, distinct=True)
    model = af.fit_model(inputs.hybrid_features(train.select(*C.pair, "stars"), "inner"), af.HYBRID_FEATURES, C, **TREES)
    scored = af.predict_model(model, inputs.hybrid_features(test.select(*C.pair), "left"), af.HYBRID_FEATURES, C)
    return af.predict_hybrid(cf, scored, af.hybrid_weight(train, test, C), C)


def rmse_item_cf(spark, folder):
    train, test = t.train(spark, folder), t.test(spark, folder)
    return rounded(af.rmse(af.predict_item_cf(train, test, C), test, C), "rmse")


def prediction_range(spark, folder):
    cf = af.predict_item_cf(t.train(spark, folder), t.test(spark, folder), C)
    return rounded(af.prediction_range(cf), "lowest", "highest")


QUERIES: dict[str, Query] = {
    "ratings_latest": ratings_latest,
    "item_stats": item_stats,
    "user_stats": user_stats,
    "split_train_test": split_train_test,
    "prepared_ratings": prepared_ratings,
    "cold_start_cells": shared(cold_start_cells),
    "user_codes": user_codes,
    "minhash_signatures": minhash_signatures,
    "lsh_universal": lsh_universal,
    "lsh_bands": lsh_bands,
    "lsh_candidates": lsh_candidates,
    "similar_items_lsh": similar_items_lsh,
    "similar_items_exact": similar_items_exact,
    "similar_sets_lsh": similar_sets_lsh,
    "similar_sets_exact": similar_sets_exact,
    "similar_items_lookup": similar_items_lookup,
    "set_families": set_families,
    "similar_items_by_raters": similar_items_by_raters,
    "lsh_precision_recall": lsh_precision_recall,
    "item_pair_similarity": shared(item_pair_similarity),
    "item_cf_rho25": item_cf(rho=2.5),
    "item_cf_rho6": item_cf(rho=6.0),
    "item_cf_topk": item_cf(rho=2.5, k=10),
    "item_cf_default_voting": item_cf(rho=2.5, mode="default_voting"),
    "item_cf_min_common": item_cf(rho=2.5, min_common=5),
    "item_cf_rescaled": item_cf(rho=2.5, rescale=True),
    "item_cf_whole_stars": item_cf(rho=2.5, round_to=0),
    "item_cf_cold_default": item_cf(rho=2.5, cold="default"),
    "item_cf_half_stars": shared(item_cf_half_stars),
    "item_cf_repeated_rows": shared(item_cf_repeated_rows),
    "co_rated_similarity": co_rated_similarity,
    "user_rating_stats": user_rating_stats,
    "user_sample_variance": user_sample_variance,
    "label_encode": label_encode,
    "train_features": train_features,
    "test_features": test_features,
    "hybrid_features": hybrid_features,
    "hybrid_train_features": hybrid_train_features,
    "feature_vectors": feature_vectors,
    "features_with_extra": features_with_extra,
    "features_numeric_text": features_numeric_text,
    "model_stump": shared(model_stump),
    "model_boosted_stumps": shared(model_boosted_stumps),
    "hybrid_stump": shared(hybrid_stump),
    "ratings_csv": ratings_csv,
    "ratings_quarantine": ratings_quarantine,
    "item_profiles_json": item_profiles_json,
    "profiles_json": profiles_json,
    "pairs_sink": pairs_sink,
    "predictions_sink": shared(predictions_sink),
    "model_predictions": shared(model_predictions),
    "hybrid_weight": hybrid_weight,
    "hybrid_weight_lifted": hybrid_weight_lifted,
    "hybrid_cf_useravg": shared(hybrid_cf_useravg),
    "hybrid_predictions": shared(hybrid_predictions),
    "rmse_item_cf": shared(rmse_item_cf),
    "prediction_range": shared(prediction_range),
}
