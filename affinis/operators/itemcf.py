"""Item-item similarity and rating prediction by item-based collaborative filtering."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.similarity import TERMS, amplify, exact_terms, fits_in_bigint, pearson_quotient, ratio_of_averages
from affinis.operators.bundles import crossed_bundles, narrowest, profile_bundles, single_bundles, unfolded
from affinis.operators.pairfilter import PairFilter, filter_of
from affinis.operators.staging import BLOCK, hot_keys, materialize, self_pairs, spread_join, stored_once
from affinis.operators.stats import RatingColumns, item_totals, pair_ratings, user_totals

log = logging.getLogger(__name__)

# Profiles above this size are cut into blocks where they are paired with themselves.
HEAVY_PROFILE = 2_000
# What a looked-up row costs, in rows made by pairing: it travels to the other item's raters, a paired one meets a filter where it is.
LOOKUP_COST = 4.0
# A filter of the wanted pairs is made where pairing makes this many times as many rows: a pair travels to its block as a paired row would.
FILTER_GAIN = 1.0
# An item that meets this many times a block of items is dealt over several partitions where pairs are added up.
HOT_BLOCKS = 50
COLD_CELLS = ("both_known", "already_rated", "cold_user", "cold_item", "both_cold")
ITEM_COLUMNS = ("total", "rows", "all_sum", "all_squares", "raters")


def item_similarity(ratings: DataFrame, pairs: DataFrame | None = None, c: RatingColumns = RatingColumns(),
                    mode: str = "common", min_common: int | None = None,
                    heavy_profile: int = HEAVY_PROFILE, block: int = BLOCK) -> DataFrame:
    """``(a, b, similarity, n_common)`` with ``a < b``.

    ``pairs`` (a, b) are the pairs to compute, in any order; without it, all pairs of items with a common user.
    Pearson correlation over common users, each item centred on its average over all its ratings. Items without a
    common user get the ratio of their averages. ``mode="default_voting"`` runs over the union of the users.
    ``min_common`` halves the similarity of pairs with fewer common users.
    """
    rated = stored_once(pair_ratings(ratings, c), "rated")
    items = stored_once(item_totals(rated), "item-totals")
    if pairs is None:
        # the totals travel with the pairs, which are too many to be joined to them on both sides
        totals = items.select("item", *(("total", "rows") if mode == "common" else ITEM_COLUMNS))
        wanted = co_rating_sums(rated, None, heavy_profile, block, totals=totals)
    else:
        asked = pairs.toDF("x", "y").where(F.col("x") != F.col("y"))
        asked = asked.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        asked = materialize(asked, "asked")
        wanted = asked.join(co_rating_sums(rated, asked, heavy_profile, block), ["a", "b"], "left")
    wanted = _with_similarity(wanted, items, largest_rating(rated), mode, min_common)
    return wanted.select("a", "b", "similarity", F.coalesce("n_common", F.lit(0)).alias("n_common"))


def cold_start_cells(train: DataFrame, pairs: DataFrame, c: RatingColumns = RatingColumns()) -> DataFrame:
    """``(user, item, cell)`` for each distinct pair; the cells are ``COLD_CELLS``."""
    rated = stored_once(pair_ratings(train, c), "rated")
    return _targets(rated, item_totals(rated), pairs, c).select(F.col("user").alias(c.user), F.col("item").alias(c.item), "cell")


def predict_item_cf(train: DataFrame, pairs: DataFrame, c: RatingColumns = RatingColumns(), rho: float = 2.5,
                    k: int | None = None, default: float = 2.5, cap: float | None = 5.0, mode: str = "common",
                    min_common: int | None = None, cold: str = "averages", round_to: int | None = None,
                    rescale: bool = False, distinct: bool = False, heavy_profile: int = HEAVY_PROFILE,
                    block: int = BLOCK) -> DataFrame:
    """``(user, item, prediction)`` for every row of ``pairs``; with ``distinct``, once per different pair.

    A rating known from ``train`` is returned as it is. A cold user gets the item's average, a cold item the
    user's, both cold ``default`` (``cold="default"`` gives ``default`` to any cold side). Otherwise the
    prediction is the average of the user's ratings weighted by the item's similarity to each rated item, positive
    similarities only, raised to ``rho``; ``k`` keeps the k most similar. Without a positive neighbour it is the
    mean of both averages. ``rescale`` maps the predictions linearly onto 1..5.
    """
    if cold not in ("averages", "default"):
        raise ValueError(f"unknown cold-start rule: {cold}")
    rated = stored_once(pair_ratings(train, c), "rated")
    items = stored_once(item_totals(rated), "item-totals")
    targets = materialize(_targets(rated, items, pairs, c), "targets")
    neighbours = _neighbours(rated, items, targets, mode, min_common, heavy_profile, block)
    neighbours = neighbours.where(F.col("similarity") > 0)
    if k is not None:
        best = Window.partitionBy("user", "item").orderBy(F.desc("similarity"), "other")
        neighbours = neighbours.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= k)
    neighbours = neighbours.withColumn("weight", amplify(F.col("similarity"), rho))
    weighted = neighbours.groupBy("user", "item").agg(
        (F.sum(F.col("rating") * F.col("weight")) / F.sum("weight")).alias("weighted"))

    unit, fallback = F.lit(float(c.unit)), F.lit(float(default))
    user_avg, item_avg = F.col("user_total") / F.col("user_rows"), F.col("total") / F.col("rows")
    found = F.coalesce(F.col("weighted"), (user_avg + item_avg) / 2) * unit
    if cap is not None:
        found = F.least(found, F.lit(float(cap)))
    on_cold_user = item_avg * unit if cold == "averages" else fallback
    on_cold_item = user_avg * unit if cold == "averages" else fallback
    prediction = (F.when(F.col("cell") == "both_known", found)
                  .when(F.col("cell") == "already_rated", F.col("known") * unit)
                  .when(F.col("cell") == "cold_user", on_cold_user)
                  .when(F.col("cell") == "cold_item", on_cold_item)
                  .otherwise(fallback))
    if round_to is not None:
        prediction = F.round(prediction, round_to)
    result = targets.join(weighted, ["user", "item"], "left").select(
        F.col("user").alias(c.user), F.col("item").alias(c.item), prediction.cast("double").alias("prediction"),
        "copies")
    if rescale:
        result = rescale_predictions(result)
    return result.drop("copies") if distinct else repeat_rows(result, targets.agg(F.max("copies")).first()[0] or 0)


def rescale_predictions(predictions: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Map the predictions linearly so that the smallest becomes ``low`` and the largest ``high``."""
    predictions = materialize(predictions, "unscaled")
    lo, hi = predictions.agg(F.min("prediction"), F.max("prediction")).first()
    if lo is None or lo == hi:
        return predictions
    scaled = (F.col("prediction") - F.lit(lo)) / F.lit(hi - lo) * F.lit(high - low) + F.lit(low)
    return predictions.withColumn("prediction", scaled)


def repeat_rows(df: DataFrame, largest: int, chunk: int = 100_000) -> DataFrame:
    """Each row ``copies`` times, without that column; ``largest`` is the largest number of copies.

    Counts above ``chunk`` are cut into chunks that are dealt out over the tasks, so no task writes all copies of a
    row and no long array is built.
    """
    kept = [x for x in df.columns if x != "copies"]
    if largest <= 1:
        return df.select(*kept)
    if largest > chunk:
        df = df.withColumn("_chunk", F.expr(f"explode(sequence(0L, (copies - 1) div {chunk}L))"))
        df = df.withColumn("copies", F.expr(f"least({chunk}L, copies - _chunk * {chunk}L)")).repartition(*kept, "_chunk")
    return df.withColumn("_copy", F.expr("explode(sequence(1L, copies))")).select(*kept)


@dataclass(frozen=True)
class AskedPairs:
    """Wanted pairs as ``bundles`` of single_bundles or crossed_bundles, their ``number``, at least the largest number of an item's, and that of each item (item, pairs)."""

    bundles: DataFrame
    number: float
    most: float
    by_item: Callable[[], DataFrame]


SUMS = ("sum_a", "sum_b", "squares_a", "squares_b", "products")


def co_rating_sums(rated: DataFrame, wanted: DataFrame | None, heavy_profile: int = HEAVY_PROFILE,
                   block: int = BLOCK, focus: DataFrame | None = None, lookup_cost: float = LOOKUP_COST, totals: DataFrame | None = None,
                   asked: AskedPairs | None = None) -> DataFrame:
    """``(a, b, n_common, sum_a, sum_b, squares_a, squares_b, products)`` over common users, ``a < b``.

    Only the co-rated rows of ``wanted`` pairs (a, b), a stored table that may repeat them, enter the sums; without it, all do. There are
    two ways to them.
    Pairing: a profile of p items makes p * (p - 1) / 2 pairs, which travel to their first item as bundles; profiles above ``heavy_profile``
    are cut into blocks. Looking up: each wanted pair goes to the raters of its first item, and those are looked up among the raters of the
    second. Profiles are classed by size (powers of two); both numbers of rows are measured for every class, and each takes the way that makes fewer,
    a looked-up row counting ``lookup_cost`` times. ``focus`` (item) leaves out pairs of which neither item is listed; then the paired rows travel
    one by one.
    ``totals`` (item, ...) are added for both items, as ``<name>_a`` and ``<name>_b``. With ``asked``, ``wanted`` needn't be stored.
    """
    if focus is not None:
        return _sum_pairs(co_rated_rows(rated, wanted, heavy_profile, block, focus, lookup_cost))
    rows, kinds = rated.select("user", "item", "rating"), narrowest(rated, ("item", "rating"))
    if totals is not None:
        rows, kinds = rows.join(totals, "item"), kinds | narrowest(totals, tuple(totals.columns[1:]))
    carry = tuple(x for x in rows.columns if x not in ("user", "item"))
    if wanted is not None and asked is None:
        pairs = wanted.select(*[F.col(x).try_cast(kinds["item"]).alias(x) for x in ("a", "b")])
        number = float(wanted.count())
        asked = AskedPairs(single_bundles(pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull()), (), kinds), number, number,
                           lambda: wanted.groupBy(F.col("a").alias("item")).agg(F.count(F.lit(1)).cast("double").alias("pairs")))
    profiles = profile_sizes(rated)
    # a wanted pair is looked up at one rater at least, or about that; with so many, no class need be measured
    by_item = asked.by_item() if asked is not None and lookup_cost * asked.number < _all_pairs(profiles) else None
    light, heavy, looked_up, made = _ways(rows, profiles, None if by_item is None else wanted, heavy_profile, block, lookup_cost, carry, by_item)
    paired = profile_bundles(light, carry, kinds)
    for others in (heavy, looked_up):
        if others is not None:
            paired = paired.unionByName(single_bundles(others, carry, kinds))
    if wanted is not None:
        paired = paired.withColumn("_wanted", F.lit(False)).unionByName(
            asked.bundles.withColumn("_wanted", F.lit(True)), allowMissingColumns=True)
        made += asked.number
    types = {x: t for x, t in rows.dtypes}
    rows = unfolded(paired, carry, types, made, _loads(rated, asked, HOT_BLOCKS * block), HOT_BLOCKS * block)
    known = [f"{x}_{side}" for x in carry[1:] for side in "ab"]
    sums = _sum_pairs(rows, [*(x for x in rows.columns if x == "_part"), *known], [F.max("_wanted").alias("_asked")] if wanted is not None else [])
    if wanted is not None:
        sums = sums.where(F.col("_asked") & (F.col("n_common") > 0))
    return sums.select(F.col("a").cast(types["item"]).alias("a"), "b", "n_common", *SUMS, *known)


def _all_pairs(profiles: DataFrame) -> float:
    size = F.col("_size").cast("double")
    return profiles.agg(F.sum(size * (size - 1) / 2)).first()[0] or 0.0


def _loads(rated: DataFrame, asked: AskedPairs | None, block: int) -> DataFrame | None:
    """``(item, load)``: at least the number of pairs that an item is the first of; None if no item can have more than ``block``."""
    profiles = profile_sizes(rated)
    most = profiles.agg(F.max("_size")).first()[0] or 0
    widest = rated.groupBy("item").agg(F.count(F.lit(1)).alias("raters")).agg(F.max("raters")).first()[0] or 0
    if most * widest + (asked.most if asked else 0) <= block:
        return None
    loads = rated.join(profiles, "user").groupBy("item").agg(F.sum(F.col("_size").cast("double")).alias("load"))
    if asked is not None:
        loads = loads.unionByName(asked.by_item().select("item", (2 * F.col("pairs")).alias("load"))).groupBy("item").agg(F.sum("load").alias("load"))
    return loads.where(F.col("item").isNotNull())


def co_rated_rows(rated: DataFrame, wanted: DataFrame | None, heavy_profile: int = HEAVY_PROFILE,
                  block: int = BLOCK, focus: DataFrame | None = None, lookup_cost: float = LOOKUP_COST) -> DataFrame:
    """The rows ``(a, b, rating_a, rating_b)`` that ``co_rating_sums`` adds up.

    Paired rows meet a filter of the wanted pairs before they are shuffled to the exact test.
    """
    light, heavy, looked_up, made = _ways(rated.select("user", "item", "rating"), profile_sizes(rated), wanted, heavy_profile, block, lookup_cost)
    paired = _profile_pairs(light, focus)
    if heavy is not None:
        paired = paired.unionByName(heavy)
    if wanted is None:
        return paired
    asked = wanted.count()
    paired = of_wanted(paired, wanted, filter_of(wanted, "a", "b", count=asked) if made >= FILTER_GAIN * asked else None)
    return paired if looked_up is None else paired.unionByName(looked_up)


def _ways(light: DataFrame, profiles: DataFrame, wanted: DataFrame | None, heavy_profile: int, block: int, lookup_cost: float,
          carry: tuple[str, ...] = ("rating",), asked: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame | None, float]:
    """The small profiles to pair, the paired rows of heavy ones, the looked-up rows of the wanted pairs, and the number of pairs made."""
    if wanted is None:
        looked_up, made = [], _all_pairs(profiles)
    else:
        looked_up, made = _looked_up_classes(light, profiles, wanted, lookup_cost, asked)
    of_class = _size_class(F.col("_size"))
    found = None
    if looked_up:
        chosen = materialize(light.join(profiles.where(of_class.isin(looked_up)).select("user"), "user", "left_semi"), "looked-up")
        profiles = profiles.where(~of_class.isin(looked_up))
        light = light.join(profiles.select("user"), "user", "left_semi")
        found = _looked_up(chosen, wanted, block)
    heavy = hot_keys(light, ["user"], heavy_profile, "_blocks", profiles.withColumnRenamed("_size", "_rows"))
    if heavy is None:
        return light, None, found, made
    busy = materialize(light.join(heavy.select("user"), "user", "left_semi"), "heavy-profiles")
    blocks = self_pairs(busy, ["user"], "item", carry, block=block).withColumnsRenamed({"item_a": "a", "item_b": "b"})
    return light.join(heavy, "user", "left_anti"), blocks.drop("user"), found, made


def profile_sizes(rated: DataFrame) -> DataFrame:
    """``(user, _size)``: number of items of every user, stored."""
    return stored_once(rated.groupBy("user").agg(F.count(F.lit(1)).alias("_size")), "profiles")


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(size)).cast("int")


def _looked_up_classes(light: DataFrame, profiles: DataFrame, wanted: DataFrame, lookup_cost: float,
                       asked: DataFrame | None = None) -> tuple[list[int], float]:
    """Classes of profile sizes for which looking up the wanted pairs makes fewer rows than pairing, and the rows that pairing the others makes.

    ``asked`` (item, pairs) are the numbers of wanted pairs that are looked up from an item, if known. At most 63 rows are collected.
    """
    size = F.col("_size").cast("double")
    paired = profiles.groupBy(_size_class(F.col("_size")).alias("class")).agg(F.sum(size * (size - 1) / 2).alias("rows")).collect()
    raters = light.join(profiles, "user").groupBy("item", _size_class(F.col("_size")).alias("class")).agg(F.count(F.lit(1)).alias("raters"))
    if asked is None:
        asked = wanted.groupBy(F.col("a").alias("item")).agg(F.count(F.lit(1)).alias("pairs"))
    lookups = raters.join(asked, "item").groupBy("class").agg(F.sum(F.col("raters").cast("double") * F.col("pairs")).alias("rows"))
    lookups = {r["class"]: r["rows"] for r in lookups.collect()}
    found, made = [], 0.0
    for r in sorted(paired, key=lambda r: r["class"]):
        looked_up = lookups.get(r["class"], 0.0)
        fewer = lookup_cost * looked_up < r["rows"]
        log.info("profiles of %d to %d items: %.0f rows by pairing, %.0f by looking up: %s", 1 << r["class"], (2 << r["class"]) - 1, r["rows"],
                 looked_up, "looked up" if fewer else "paired")
        if fewer:
            found.append(r["class"])
        else:
            made += r["rows"]
    return found, made


def _looked_up(chosen: DataFrame, wanted: DataFrame, block: int) -> DataFrame:
    """The co-rated rows of the wanted pairs in the stored profiles ``chosen``, by looking up."""
    items = chosen.select("item").distinct()
    asked = wanted.select("a", "b").distinct().join(items.withColumnRenamed("item", "a"), "a", "left_semi").join(
        items.withColumnRenamed("item", "b"), "b", "left_semi")
    first = chosen.select(F.col("item").alias("a"), "user", F.col("rating").alias("rating_a"))
    second = chosen.select(F.col("item").alias("b"), "user", F.col("rating").alias("rating_b"))
    co_rated = spread_join(materialize(asked, "asked-lookups"), first, ["a"], block=block)
    return co_rated.join(second, ["b", "user"]).select("a", "b", "rating_a", "rating_b")


def of_wanted(co_rated: DataFrame, wanted: DataFrame, pair_filter: PairFilter | None) -> DataFrame:
    """The co-rated rows of the wanted pairs: a filter drops most others where they are made, an exact join the rest."""
    if pair_filter is not None:
        co_rated = pair_filter.keep(co_rated, "a", "b")
    return co_rated.join(wanted.select("a", "b"), ["a", "b"], "left_semi")


def _profile_pairs(light: DataFrame, focus: DataFrame | None) -> DataFrame:
    right = light.select("user", F.col("item").alias("b"), F.col("rating").alias("rating_b"))
    if focus is None:
        left = light.select("user", F.col("item").alias("a"), F.col("rating").alias("rating_a"))
        return left.join(right, "user").where(F.col("a") < F.col("b")).select("a", "b", "rating_a", "rating_b")
    left = light.join(focus, "item", "left_semi").select(
        "user", F.col("item").alias("a"), F.col("rating").alias("rating_a"))
    right = right.join(focus.select(F.col("item").alias("b"), F.lit(True).alias("listed")), "b", "left")
    once = F.col("listed").isNull() | (F.col("a") < F.col("b"))
    pairs = left.join(right, "user").where((F.col("a") != F.col("b")) & once)
    swap = F.col("a") > F.col("b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(swap, F.col("rating_b")).otherwise(F.col("rating_a")).alias("rating_a"),
                        F.when(swap, F.col("rating_a")).otherwise(F.col("rating_b")).alias("rating_b"))


def _sum_pairs(co_rated: DataFrame, keys: list[str] | None = None, more: list[Column] | None = None) -> DataFrame:
    ra, rb = F.col("rating_a").cast("bigint"), F.col("rating_b").cast("bigint")
    return co_rated.groupBy("a", "b", *(keys or [])).agg(
        *(more or []), F.count("rating_a").alias("n_common"), F.sum(ra).alias("sum_a"), F.sum(rb).alias("sum_b"),
        F.sum(ra * ra).alias("squares_a"), F.sum(rb * rb).alias("squares_b"), F.sum(ra * rb).alias("products"))


def largest_rating(rated: DataFrame) -> int:
    return rated.agg(F.max(F.abs("rating"))).first()[0] or 0


def _with_similarity(pairs: DataFrame, items: DataFrame, largest: int, mode: str, min_common: int | None) -> DataFrame:
    """Add ``similarity`` to pairs (a, b) that hold their common sums, if any; ``items`` has the totals of each item.

    The exact terms are columns of their own, so that each is computed once and the generated code stays small enough
    to be compiled. If all terms fit in bigints, as the largest number of ratings of an item tells, the code holds that type
    only; else pairs that fit and pairs that don't are parted first.
    """
    if mode not in TERMS:
        raise ValueError(f"unknown similarity mode: {mode}")
    for side in ("a", "b") if "total_a" not in pairs.columns else ():
        totals = items.select(F.col("item").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in ITEM_COLUMNS])
        pairs = pairs.join(totals, side)
    most = items.agg(F.max("rows")).first()[0] or 0
    if fits_in_bigint(mode, largest, most):
        pairs = _with_terms(pairs, mode, largest, "small")
    else:
        pairs = materialize(pairs, "pair-sums")
        small = F.expr(fits_in_bigint(mode, largest))
        pairs = _with_terms(pairs.where(small), mode, largest, "small").unionByName(
            _with_terms(pairs.where(~small), mode, largest, "large"))
    pearson = pearson_quotient(F.col("_top"), F.col("_norm_a"), F.col("_norm_b"))
    if min_common is not None:
        pearson = pearson * F.when(F.col("n_common") < min_common, F.lit(0.5)).otherwise(F.lit(1.0))
    averages = ratio_of_averages(F.col("total_a") / F.col("rows_a"), F.col("total_b") / F.col("rows_b"))
    return pairs.withColumn("similarity", F.when(F.col("n_common").isNull(), averages).otherwise(pearson))


def _with_terms(pairs: DataFrame, mode: str, largest: int, size: str) -> DataFrame:
    return pairs.withColumns({f"_{name}": F.expr(sql) for name, sql in exact_terms(mode, largest, size).items()})


def _targets(rated: DataFrame, items: DataFrame, pairs: DataFrame, c: RatingColumns) -> DataFrame:
    """Distinct pairs with their number of copies, the totals of both sides, the known rating, and the cell."""
    asked = pairs.groupBy(F.col(c.user).alias("user"), F.col(c.item).alias("item")).agg(
        F.count(F.lit(1)).alias("copies"))
    known = rated.select("user", "item", F.col("rating").alias("known"))
    users = user_totals(rated).withColumnsRenamed({"total": "user_total", "rows": "user_rows"})
    targets = (asked.join(known, ["user", "item"], "left").join(users, "user", "left")
               .join(items, "item", "left"))
    both, rated_before, cold_user, cold_item, both_cold = COLD_CELLS
    has_user, has_item = F.col("user_rows").isNotNull(), F.col("rows").isNotNull()
    cell = (F.when(F.col("known").isNotNull(), rated_before).when(has_user & has_item, both)
            .when(has_item, cold_user).when(has_user, cold_item).otherwise(both_cold))
    return targets.withColumn("cell", cell)


def _neighbours(rated: DataFrame, items: DataFrame, targets: DataFrame, mode: str, min_common: int | None, heavy_profile: int,
                block: int) -> DataFrame:
    """``(user, item, other, rating, similarity)``: each open pair against the user's whole profile.

    Pearson similarities are made for co-rated pairs only, once each. A pair without a common user takes the ratio of the averages, which
    both sides bring along, so it meets no table of pairs.
    """
    average = F.col("total") / F.col("rows")
    open_pairs = targets.where(F.col("cell") == "both_known").select("user", "item", average.alias("item_average"))
    profile = rated.select("user", F.col("item").alias("other"), "rating").join(
        items.select(F.col("item").alias("other"), average.alias("other_average")), "other")
    sizes = profile_sizes(rated).withColumnRenamed("_size", "_rows")
    # Rows multiply here: a shuffle by user keeps all tasks busy where a small broadcast side would not.
    rows = spread_join(open_pairs.hint("merge"), profile, ["user"], block=block, right_sizes=sizes)
    rows = rows.select("user", "item", "other", "rating", F.least("item", "other").alias("a"),
                       F.greatest("item", "other").alias("b"), ratio_of_averages(F.col("item_average"), F.col("other_average")).alias("ratio"))
    focus = targets.where(F.col("cell") == "both_known").select("item").distinct()
    # where most items are asked for, marking them would cost more than it saves
    focus = materialize(focus, "focus")
    if 2 * focus.count() < items.count():
        sums = co_rating_sums(rated, materialize(rows.select("a", "b"), "wanted"), heavy_profile, block, focus)
    else:
        asked = _asked_pairs(rated, open_pairs.select("user", "item"), heavy_profile, block)
        sums = co_rating_sums(rated, rows.select("a", "b"), heavy_profile, block, asked=asked)
    pairs = _with_similarity(sums, items, largest_rating(rated), mode, min_common)
    pairs = materialize(pairs.select("a", "b", F.col("similarity").alias("pearson"), F.lit(True).alias("co_rated")), "similarities")
    # rows of pairs without a common user stay where they are made
    known = filter_of(pairs, "a", "b")
    near, far = (rows, None) if known is None else known.part(rows, "a", "b")
    found = near.join(pairs, ["a", "b"], "left").withColumn("similarity", F.when(F.col("co_rated"), F.col("pearson")).otherwise(F.col("ratio")))
    columns = ("user", "item", "other", "rating", "similarity")
    return found.select(*columns) if far is None else found.select(*columns).unionByName(far.withColumnRenamed("ratio", "similarity").select(*columns))


def _asked_pairs(rated: DataFrame, open_pairs: DataFrame, heavy_profile: int, block: int) -> AskedPairs:
    """The pairs of an open item with an item of its user's profile."""
    profiles = profile_sizes(rated)
    tests = materialize(open_pairs.groupBy("user").agg(F.count(F.lit(1)).alias("_tests")), "asked-sizes")

    def by_item():
        # each pair counts half for either item, since the lesser one becomes the first
        halves = [open_pairs.join(profiles, "user").select("item", F.col("_size").alias("_pairs")),
                  rated.join(tests, "user").select("item", F.col("_tests").alias("_pairs"))]
        asked = halves[0].unionByName(halves[1]).groupBy("item").agg((F.sum(F.col("_pairs").cast("double")) / 2).alias("pairs"))
        return materialize(asked, "asked-items")

    size, asked_size = F.col("_size").cast("double"), F.col("_tests").cast("double")
    number, most, most_asked = profiles.join(tests, "user").agg(F.sum(size * asked_size), F.max(size), F.max(asked_size)).first()
    widest = [x.groupBy("item").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0 for x in (open_pairs, rated)]
    bound = widest[0] * (most or 0.0) + widest[1] * (most_asked or 0.0)

    kinds = narrowest(rated, ("item",))
    busy = profiles.join(tests, "user").where(F.greatest("_size", "_tests") > heavy_profile).select("user")
    busy = materialize(busy, "busy")
    sides, loose = [open_pairs, rated.select("user", "item")], None
    if not busy.isEmpty():
        few = [x.join(busy, "user", "left_semi") for x in sides]
        sides = [x.join(busy, "user", "left_anti") for x in sides]
        loose = spread_join(materialize(few[0], "busy-open"), materialize(few[1].withColumnRenamed("item", "other"), "busy-rated"), ["user"], block=block)
        loose = loose.select(F.least("item", "other").alias("a"), F.greatest("item", "other").alias("b"))
    item = F.col("item").cast(kinds["item"])
    bundles = crossed_bundles(*[x.groupBy("user").agg(F.collect_list(item).alias("items")) for x in sides], kinds["item"])
    bundles = bundles if loose is None else bundles.unionByName(single_bundles(loose, (), kinds))
    return AskedPairs(bundles, number or 0.0, bound, by_item)
