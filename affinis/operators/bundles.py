"""Item pairs that travel as bundles: one row holds an item and the greater items that it meets in a profile.

A row a pair costs its key, its lengths and its other columns for every pair. A bundle ``(a, bs, ...)`` pays them once, its arrays hold the
smallest number type that fits, and the pairs of an item meet in the partition of the item, where they are unfolded and added up without another
shuffle. An item that makes more pairs than a block is dealt over several partitions by its partner.

Items that take 32 bits travel as two arrays of 16 bits: the upper halves of sorted items come in runs, which a shuffle's compression takes out;
four-byte numbers of which only the lower bytes differ it doesn't compress. So ``bs`` has the lower halves there and ``_high_bs`` the upper ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.operators.staging import materialize

# Unfolded pairs of a partition.
PAIRS = 1_500_000
WIDTHS = (("tinyint", 7), ("smallint", 15), ("int", 31))
NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _halves(item: Column) -> tuple[Column, Column]:
    """Lower and upper 16 bits of an int."""
    return F.shiftright(F.shiftleft(item, 16), 16).cast("smallint"), F.shiftright(item, 16).cast("smallint")


def _whole(low: Column, high: Column) -> Column:
    return F.shiftleft(high.cast("int"), 16).bitwiseOR(low.cast("int").bitwiseAND(F.lit(0xFFFF)))


def _packed(items: Column, kind: str) -> dict[str, Column]:
    """Arrays that an array of items travels as."""
    if kind != "int":
        return {"bs": items}
    return {"bs": F.transform(items, lambda v: _halves(v)[0]), "_high_bs": F.transform(items, lambda v: _halves(v)[1])}


def narrowest(rows: DataFrame, names: tuple[str, ...]) -> dict[str, str]:
    """The smallest type for each column that holds all its whole numbers; other columns keep their type."""
    kinds = dict(rows.dtypes)
    whole = [x for x in names if kinds[x] in NUMBERS]
    found = {x: kinds[x] for x in names}
    if whole:
        ends = rows.agg(*[F.min(x).alias(f"{x}_low") for x in whole], *[F.max(x).alias(f"{x}_high") for x in whole]).first()
        for x in whole:
            low, high = ends[f"{x}_low"] or 0, ends[f"{x}_high"] or 0
            found[x] = next((kind for kind, bits in WIDTHS if -(1 << bits) <= low and high < 1 << bits), "bigint")
    return found


def profile_bundles(rows: DataFrame, carry: tuple[str, ...], kinds: dict[str, str]) -> DataFrame:
    """Bundles of all pairs of items of a user; ``carry`` gives ``<name>_a`` and arrays ``<name>_bs``. Profiles have to be small enough for a row."""
    names = ("item", *carry)
    rows = rows.where(F.col("user").isNotNull() & F.col("item").isNotNull())
    entries = rows.select("user", F.struct(*[F.col(x).cast(kinds[x]).alias(x) for x in names]).alias("entry"))
    profiles = entries.groupBy("user").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    profiles = profiles.select(*[F.col(f"entries.{x}").alias(f"{x}s") for x in names]).where(F.size("items") > 1)
    packed = _packed(F.col("items"), kinds["item"])
    profiles = profiles.select("items", *[f"{x}s" for x in carry], *[x.alias(name) for name, x in packed.items()])
    placed = profiles.select(F.posexplode("items").alias("at", "a"), F.size("items").alias("size"), *[f"{x}s" for x in carry], *packed)
    placed = placed.where(F.col("at") < F.col("size") - 1)

    def later(name: str) -> Column:
        return F.slice(name, F.col("at") + 2, F.col("size"))

    return placed.select("a", *[later(x).alias(x) for x in packed], *[F.element_at(f"{x}s", F.col("at") + 1).alias(f"{x}_a") for x in carry],
                         *[later(f"{x}s").alias(f"{x}_bs") for x in carry])


def single_bundles(pairs: DataFrame, carry: tuple[str, ...], kinds: dict[str, str]) -> DataFrame:
    """A bundle for each row (a, b, ``<name>_a``, ``<name>_b``)."""
    return pairs.select(F.col("a").cast(kinds["item"]).alias("a"), *_single(F.col("b").cast(kinds["item"]), kinds["item"]),
                        *[F.col(f"{x}_a").cast(kinds[x]).alias(f"{x}_a") for x in carry],
                        *[F.array(F.col(f"{x}_b").cast(kinds[x])).alias(f"{x}_bs") for x in carry])


def _single(item: Column, kind: str) -> list[Column]:
    """The arrays of one item."""
    if kind != "int":
        return [F.array(item).alias("bs")]
    return [F.array(half).alias(name) for name, half in zip(("bs", "_high_bs"), _halves(item), strict=True)]


def crossed_bundles(asked: DataFrame, profiles: DataFrame, kind: str) -> DataFrame:
    """Bundles ``(a, bs)`` of each asked item with each item of its user's profile; (user, items) on both sides, one row a user.

    ``kind`` is the items' type.
    """
    both = profiles.select("user", F.sort_array("items").alias("_known")).join(asked.select("user", F.sort_array("items").alias("_asked")), "user")
    sides = [both.select(F.explode(x).alias("a"), y).select("a", F.filter(y, lambda v: v > F.col("a")).alias("bs"))
             for x, y in (("_asked", "_known"), ("_known", "_asked"))]
    found = sides[0].unionByName(sides[1]).where(F.size("bs") > 0)
    return found.select("a", *[x.alias(name) for name, x in _packed(F.col("bs"), kind).items()])


def unfolded(bundles: DataFrame, carry: tuple[str, ...], types: dict[str, str], pairs: float, loads: DataFrame | None, block: int) -> DataFrame:
    """``(a, b, <name>_a, <name>_b, ...)``, partitioned by ``a``, and by a ``_part`` where items are dealt out, so that rows of a pair lie together.

    ``pairs`` is about the number of pairs, ``loads`` (item, load) that of an item; with more than ``block``, an item is dealt over several parts.
    ``types`` are the types to come back to.
    """
    place, hot = ["a"], None
    if loads is not None:
        hot = materialize(loads.where(F.col("load") > block).select(
            F.col("item").alias("a"), F.ceil(F.col("load") / F.lit(float(block))).cast("int").alias("_parts")), "hot-items")
        hot = None if hot.isEmpty() else hot
    if hot is None:
        dealt = bundles
    else:
        place = ["a", "_part"]
        flat = [x for x in bundles.columns if x != "bs" and not x.endswith("_bs")]
        marked = bundles.join(hot, "a", "left")
        loose = _opened(marked.where(F.col("_parts").isNotNull()), [*flat, "_parts"], carry)
        loose = loose.select(*flat, *_single(F.col("b"), "int" if "_high_bs" in bundles.columns else ""), *[F.when(F.col(f"{x}_b").isNotNull(), F.array(f"{x}_b")).alias(f"{x}_bs") for x in carry],
                             F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int").alias("_part"))
        dealt = marked.where(F.col("_parts").isNull()).drop("_parts").withColumn("_part", F.lit(0).cast("int")).unionByName(loose)
    spark = bundles.sparkSession
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-pairs // PAIRS)))
    dealt = dealt.repartition(number, *place)
    flat = [x for x in dealt.columns if x != "bs" and not x.endswith("_bs")]
    rows = _opened(dealt, flat, carry)
    back = {"a": types["item"], "b": types["item"], **{f"{x}_{s}": types[x] for x in carry for s in "ab"}}
    return rows.select(*[F.col(x).cast(back[x]).alias(x) if x in back and x != "a" else F.col(x) for x in rows.columns])


def _opened(rows: DataFrame, flat: list[str], carry: tuple[str, ...]) -> DataFrame:
    halved = "_high_bs" in rows.columns
    at = rows.select(*flat, *[f"{x}_bs" for x in carry], *(["_high_bs"] if halved else []), F.posexplode("bs").alias("_at", "b"))
    item = _whole(F.col("b"), F.col("_high_bs")[F.col("_at")]).alias("b") if halved else F.col("b")
    return at.select(*flat, item, *[F.col(f"{x}_bs")[F.col("_at")].alias(f"{x}_b") for x in carry])
