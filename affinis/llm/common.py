"""Small helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinis.operators.staging import materialize


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, unless their path has it already."""
    package = Path(__file__).resolve().parents[1]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if package.parent in paths or app in _SHIPPED:
        return
    archive = f"{tempfile.mkdtemp()}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fingerprint(column: str = "text") -> Column:
    """128-bit fingerprint of a text as 16 bytes; equal texts are told by it."""
    return F.unhex(F.md5(text_of(column).cast("binary")))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(df: DataFrame, text: str = "text") -> Column:
    """Key of a row by all its columns: the fingerprint of its text, and a hash of the others. Rows of one key can't be told apart."""
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    return F.struct(fingerprint(text).alias("fp"), F.xxhash64(*others, *[c.isNull() for c in others], F.col(text).isNull()).alias("rest"))


COPIES_AT_ONCE = 1 << 16


def expanded(df: DataFrame, copies: str, number: str, most: int | None = None, at_once: int = COPIES_AT_ONCE) -> DataFrame:
    """Each row ``copies`` times, with ``number`` from 0; a row of more than ``at_once`` copies is dealt over the tasks in pieces.

    ``most`` is the greatest number of copies, where it is known.
    """
    one = F.lit(1).cast("long")
    if most is None:
        most = df.agg(F.max(copies)).first()[0] or 0
    if most <= 1:
        return df.withColumn(number, F.lit(0).cast("long"))
    block = unused(df, "_block")
    if most > at_once:
        pieces = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col(copies) - one, F.lit(at_once).cast("long")))
        df = df.withColumn(block, F.explode(pieces))
        df = df.repartition(*[c for c in df.columns if df.schema[c].dataType.typeName() != "map"])
    else:
        df = df.withColumn(block, F.lit(0).cast("long"))
    first = F.col(block) * at_once
    return df.withColumn(number, F.explode(F.sequence(first, F.least(first + at_once, F.col(copies)) - one))).drop(block)


def running_totals(df: DataFrame, group: list[str], bucket: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Adds to each row the sum of every value column over the earlier rows of its group (``values``: column -> new name).

    Rows are ordered by (``bucket``, ``order``). The sums over whole buckets are added up per group over one row per bucket;
    only the rows of one bucket are ordered together, so buckets are to be kept small. ``df`` should be a stored table:
    it is read twice. Null groups count as groups.
    """
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_sum_{n}") for v, n in values.items()])
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = sums.select(*[F.col(k).alias(f"_at_{k}") for k in keys],
                         *[F.coalesce(F.sum(f"_sum_{n}").over(before), zero).alias(f"_start_{n}") for n in values.values()])
    on = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, on, "left").drop(*[f"_at_{k}" for k in keys])
    for v, n in values.items():
        joined = joined.withColumn(n, F.col(f"_start_{n}") + F.coalesce(F.sum(v).over(within), zero))
    return joined.drop(*[f"_start_{n}" for n in values.values()])


FILE_ROWS = 100_000


def _files(rows: int) -> int:
    """Files for a small table of so many rows: rounds over few links shouldn't make a task for every shuffle partition."""
    return max(1, -(-rows // FILE_ROWS))


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the undirected ``edges (a, b)``; the label is the least node of its component.

    Alternates large-star and small-star steps: each is one aggregate (the least neighbour) and one join with it, so a node with
    many neighbours is never collected. Every round is stored. It ends when a round changes nothing.
    """
    a, b = F.col("a"), F.col("b")
    files = _files(edges.count())
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(a != b).distinct()
    edges = materialize(edges.coalesce(files), "links")
    before = _state(edges)
    while True:
        # large star: neighbours above a node go to the least one around it
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where(a > F.col("m")).select("a", F.col("m").alias("b"))).distinct()
        # small star: neighbours below a node, and the node, go to the least of them
        large = materialize(large.coalesce(files), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        small = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct().coalesce(files), "small-star")
        after = _state(small)
        if after == before:
            break
        edges, before = small, after
    labels = small.select(a.alias("node"), b.alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def merged_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels (node, label)`` after adding the ``edges (a, b)``; only the classes that these join are worked on."""
    count = edges.count()
    if not count:
        return labels
    for side in "ab":
        known = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        edges = edges.join(known, side, "left")
    edges = materialize(edges.select("a", "b", *[F.coalesce(f"label_{x}", x).alias(f"label_{x}") for x in "ab"]).coalesce(_files(count)), "new-links")
    joined = components(edges.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("least"))
    nodes = labels
    for side in "ab":
        nodes = nodes.unionByName(edges.select(F.col(side).alias("node"), F.col(f"label_{side}").alias("label")))
    nodes = nodes.distinct().join(joined, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    return materialize(nodes.coalesce(_files(labels.count() + 2 * count)), "labels")


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
