"""Ratings, profiles and baskets derived from the given tables.

A line item is a rating: the customer is the user, the part the item, the quantity gives 1 to 5 stars. Every rating
row goes to exactly one of train and test. Users and items that a hash holds out are only in test, so all four
cold-start cells occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.hashing import hash_fraction
from affinis.operators.features import COMPLIMENT_FEATURES
from affinis.operators.staging import sharing, stored_once, wide_scan
from affinis.operators.stats import RatingColumns, latest_ratings

COLUMNS = RatingColumns(user="user_id", item="item_id", stars="stars", order=("ok", "ln", "sk"))
TEST_ORDERS, COLD_USERS, COLD_ITEMS = 0.2, 0.03, 0.02


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _rated_lines(spark, folder).select("user_id", "item_id", "stars", "ok", "ln", "sk")


def _rated_lines(spark: SparkSession, folder: str, *order_columns: Column) -> DataFrame:
    stars = F.least(F.lit(5).cast("bigint"), F.ceil(F.col("l_quantity") / 10).cast("bigint"))
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_suppkey").alias("sk"),
        F.col("l_partkey").alias("item_id"), stars.alias("stars"), "l_returnflag")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("user_id"))
    return wide_scan(lines, "ok").join(orders.select("*", *order_columns), "ok")


def train_and_test_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # order and user are the same for all lines of an order, so their hashes are taken before the join
    by_order = (hash_fraction("ok", seed="order") < TEST_ORDERS) | (hash_fraction("user_id", seed="user") < COLD_USERS)
    by_item = hash_fraction("item_id", seed="item") < COLD_ITEMS
    rows = _rated_lines(spark, folder, by_order.alias("by_order"))
    columns = ("user_id", "item_id", "stars", "ok", "ln", "sk")
    rows = rows.select(*columns, (F.col("by_order") | by_item).alias("held_out"))
    if sharing():  # several parts of a query read the split
        rows = stored_once(rows, "split")
    return rows.where(~F.col("held_out")).select(*columns), rows.where("held_out").select(*columns)


def train(spark: SparkSession, folder: str) -> DataFrame:
    return train_and_test_rows(spark, folder)[0]


def test(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct test pairs with their latest rating."""
    return latest_ratings(train_and_test_rows(spark, folder)[1], COLUMNS)


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of the customers in credit, with the average in hundredths rounded half up."""
    return _user_profiles(_rated_lines(spark, folder), spark, folder, [])


def hybrid_users(spark: SparkSession, folder: str) -> DataFrame:
    """The same profiles with the compliment counters, taken from return flags and part sizes."""
    sizes = table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), "p_size")
    lines = _rated_lines(spark, folder).join(sizes, "item_id")
    flags = {"funny": F.col("l_returnflag") == "A", "cool": F.col("l_returnflag") == "N"}
    kinds = [x for x in COMPLIMENT_FEATURES if x not in flags]
    counters = flags | {x: F.col("p_size") % len(kinds) == i for i, x in enumerate(kinds)}
    return _user_profiles(lines, spark, folder, [F.count_if(f).alias(x) for x, f in counters.items()])


def _user_profiles(lines: DataFrame, spark: SparkSession, folder: str, counters: list) -> DataFrame:
    in_credit = table(spark, folder, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    average = F.expr("((200 * sum(stars) + count(*)) div (2 * count(*))) / 100.0").cast("double")
    return lines.join(in_credit, "user_id", "left_semi").groupBy("user_id").agg(
        average.alias("average_stars"), F.count(F.lit(1)).alias("review_count"),
        F.countDistinct("sk").alias("useful"), F.countDistinct("ok").alias("fans"), *counters)


def tips(spark: SparkSession, folder: str) -> DataFrame:
    """A profile keyed by user and item: number of training ratings, and of those of four stars or more."""
    return train(spark, folder).groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("tips"), F.count_if(F.col("stars") >= 4).alias("likes"))


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of the parts above size 1, with the average in half stars rounded half up."""
    listed = table(spark, folder, "part").where("p_size > 1").select(F.col("p_partkey").alias("item_id"))
    average = F.expr("((4 * sum(stars) + count(*)) div (2 * count(*))) / 2.0").cast("double")
    return ratings(spark, folder).join(listed, "item_id", "left_semi").groupBy("item_id").agg(
        average.alias("stars"), F.count(F.lit(1)).alias("review_count"))


#: what is wrong with a line, by the remainder of its order; others are whole
BROKEN = 11


def rating_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The training ratings as lines of CSV, some of them broken: without stars, with a word for stars, with a field too many."""
    user, item, stars = (F.col(c).cast("string") for c in ("user_id", "item_id", "stars"))
    kind = F.col("ok") % BROKEN
    fields = (F.when(kind == 1, F.array(user, item)).when(kind == 2, F.array(user, item, F.concat(F.lit("star"), stars)))
              .when(kind == 3, F.array(user, item, stars, F.lit("x"))).otherwise(F.array(user, item, stars)))
    return train(spark, folder).select(F.array_join(fields, ",").alias("line"))


def shingles(spark: SparkSession, folder: str, width: int = 3) -> DataFrame:
    """Baskets of documents: every run of three words of the whole text, once per document.

    Words are runs of letters and digits of any script. A text of fewer words has one run of all of them.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    docs = wide_scan(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.select(F.col("doc_id").alias("item"), words.alias("t"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("t") - (width - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice("t", i, width), " "))
    return docs.where(F.size("t") > 0).select("item", F.explode(F.array_distinct(runs)).alias("member"))


def needed_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Item pairs that predictions for test need: a test item with each item its user rated in train."""
    rated = train(spark, folder).select("user_id", F.col("item_id").alias("b")).distinct()
    asked = test(spark, folder).select("user_id", F.col("item_id").alias("a"))
    return asked.join(rated, "user_id").where("a <> b").select("a", "b").distinct()
