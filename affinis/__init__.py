"""Ratings in, similar items and predicted ratings out: Spark operators for recommendation data."""

from affinis.operators.encode import dense_codes, label_encode
from affinis.operators.evaluate import pair_precision_recall, prediction_range, rmse
from affinis.operators.features import HYBRID_FEATURES, MODEL_FEATURES, build_features, feature_matrix
from affinis.operators.hybrid import hybrid_weight, lifted_weight, predict_hybrid
from affinis.operators.itemcf import cold_start_cells, item_similarity, predict_item_cf, rescale_predictions
from affinis.operators.jaccard import (lsh_bands, lsh_candidates, member_codes, minhash_signatures, set_families,
                                       similar_items, similar_items_exact, similar_items_lsh, similar_sets_exact, similar_sets_lsh)
from affinis.operators.model import fit_model, predict_model
from affinis.operators.similar import SimilarItems
from affinis.operators.staging import shared_tables, stored_tables
from affinis.operators.stats import RatingColumns, item_stats, latest_ratings, user_rating_stats, user_stats
from affinis.sources.ratings import (prepare_ratings, read_checked, read_item_profiles, read_predictions, read_ratings,
                                     read_similar_pairs, read_user_profiles, split_ratings, write_pairs,
                                     write_predictions, write_ratings)

__all__ = [
    "HYBRID_FEATURES", "MODEL_FEATURES", "RatingColumns", "SimilarItems", "build_features", "cold_start_cells", "dense_codes",
    "feature_matrix", "fit_model", "hybrid_weight", "item_similarity", "item_stats", "label_encode",
    "latest_ratings", "lifted_weight", "lsh_bands", "lsh_candidates", "member_codes", "minhash_signatures",
    "pair_precision_recall", "predict_hybrid", "predict_item_cf", "predict_model", "prediction_range",
    "prepare_ratings", "read_checked", "read_item_profiles", "read_predictions", "read_ratings", "read_similar_pairs",
    "read_user_profiles", "rescale_predictions", "rmse", "set_families", "shared_tables", "similar_items", "similar_items_exact", "similar_items_lsh",
    "similar_sets_exact", "similar_sets_lsh", "split_ratings", "stored_tables", "user_rating_stats", "user_stats", "write_pairs", "write_predictions", "write_ratings",
]
