"""Rating aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RatingColumns:
    """Names of the rating columns.

    ``order`` lists columns that tell which of several ratings of one pair is the latest; the rating itself is the
    last tie-break. ``unit`` is the step of the rating scale (0.5 for half stars).
    """

    user: str = "user_id"
    item: str = "business_id"
    stars: str = "stars"
    order: tuple[str, ...] = ()
    unit: float = 1.0

    @property
    def pair(self) -> list[str]:
        return [self.user, self.item]

    def steps(self) -> Column:
        """The rating as a whole number of units; a rating off the scale is an error."""
        scaled = F.col(self.stars) / F.lit(float(self.unit))
        whole = F.round(scaled).cast("bigint")
        return F.when(scaled == whole, whole).when(scaled.isNull(), F.lit(None).cast("bigint")).otherwise(
            F.raise_error(F.concat(F.lit("rating is not a multiple of the unit: "), scaled.cast("string"))))


def latest_ratings(ratings: DataFrame, c: RatingColumns) -> DataFrame:
    """One rating per (user, item): the latest by ``c.order``, then the highest."""
    newest = F.max_by(c.stars, F.struct(*c.order, c.stars))
    return ratings.groupBy(*c.pair).agg(newest.alias(c.stars))


def pair_ratings(ratings: DataFrame, c: RatingColumns) -> DataFrame:
    """``(user, item, rating, total, rows)``: latest rating in units, and sum and count over the raw rows.

    Everything the predictors need about ratings follows from this table, so raw rows are read once.
    """
    rows = ratings.select(F.col(c.user).alias("user"), F.col(c.item).alias("item"), c.steps().alias("steps"),
                          *[F.col(o).alias(f"_o{i}") for i, o in enumerate(c.order)])
    newest = F.max_by("steps", F.struct(*[f"_o{i}" for i in range(len(c.order))], "steps"))
    return rows.groupBy("user", "item").agg(newest.alias("rating"), F.sum("steps").alias("total"),
                                            F.count("steps").alias("rows"))


def item_totals(pairs: DataFrame) -> DataFrame:
    """Per item: raw sum and count, and sum, squares and number over its distinct users."""
    return pairs.groupBy("item").agg(
        F.sum("total").alias("total"), F.sum("rows").alias("rows"), F.sum("rating").alias("all_sum"),
        F.sum(F.col("rating") * F.col("rating")).alias("all_squares"), F.count(F.lit(1)).alias("raters"))


def user_totals(pairs: DataFrame) -> DataFrame:
    """Per user: raw sum and count, and the profile size (distinct items)."""
    return pairs.groupBy("user").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"),
                                     F.count(F.lit(1)).alias("profile"))


def item_stats(ratings: DataFrame, c: RatingColumns) -> DataFrame:
    """Per item: sum, count and average over all rating rows, and the number of distinct users."""
    pairs = ratings.groupBy(*c.pair).agg(F.sum(c.stars).alias("s"), F.count(c.stars).alias("n"))
    return pairs.groupBy(c.item).agg(F.sum("s").alias("rating_sum"), F.sum("n").alias("rating_count"),
                                     (F.sum("s") / F.sum("n")).alias("rating_avg"),
                                     F.count(F.lit(1)).alias("raters"))


def user_stats(ratings: DataFrame, c: RatingColumns) -> DataFrame:
    """Per user: sum, count and average over all rating rows, and the profile size."""
    pairs = ratings.groupBy(*c.pair).agg(F.sum(c.stars).alias("s"), F.count(c.stars).alias("n"))
    return pairs.groupBy(c.user).agg(F.sum("s").alias("rating_sum"), F.sum("n").alias("rating_count"),
                                     (F.sum("s") / F.sum("n")).alias("rating_avg"),
                                     F.count(F.lit(1)).alias("profile"))


def user_rating_stats(train: DataFrame, users: DataFrame, items: DataFrame | None = None,
                      c: RatingColumns = RatingColumns(), variance: str = "profile_mean") -> DataFrame:
    """``(user, user_variance, user_max, user_min, rating_rows)`` over the training rows that have profiles.

    ``variance="profile_mean"`` is the mean squared deviation from the profile's ``average_stars``;
    ``"sample"`` is the sample variance around the user's own mean (null for a single row).
    """
    rows = train.join(users.select(c.user, "average_stars"), c.user)
    if items is not None:
        rows = rows.join(items.select(c.item), c.item, "left_semi")
    around = F.avg(F.pow(F.col(c.stars) - F.col("average_stars"), F.lit(2.0)))
    if variance not in ("profile_mean", "sample"):
        raise ValueError(f"unknown variance: {variance}")
    spread = around if variance == "profile_mean" else F.var_samp(c.stars)
    return rows.groupBy(c.user).agg(spread.alias("user_variance"), F.max(c.stars).alias("user_max"),
                                    F.min(c.stars).alias("user_min"), F.count(F.lit(1)).alias("rating_rows"))
