"""Intermediate tables and skew-safe many-to-many joins.

A table that several later jobs read is written once to the folder named by ``spark.checkpoint.dir``. That cuts
the lineage, survives lost executors, and gives later plans true sizes and column pruning.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 20_000


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables; a temporary one only where Spark runs in this process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="affinis-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the staging folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/affinis/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def joined_where_they_are(spark: SparkSession) -> Iterator[None]:
    """Within it, sides that are both partitioned by one of several join keys are joined without another exchange; jobs must run inside."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_SCOPES: list[list[str]] = []


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, on leaving, the tables that were stored inside; results must be written or collected before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_SHARED: list[list[tuple[int, DataFrame, DataFrame]]] = []


@contextmanager
def shared_tables() -> Iterator[None]:
    """Within it, ``stored_once`` finds a table again that was stored from the same plan, whoever asks for it.

    An inner scope sees the tables of the outer ones. Leaving the scope forgets the tables but doesn't remove them, so
    results may be read later.
    """
    _SHARED.append([])
    try:
        yield
    finally:
        _SHARED.pop()


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, but once for equal plans within a scope of ``shared_tables``.

    Plans are told by their fingerprint and then compared: equal are those that read the same files and do the same to them.
    """
    table = stored_before(df)
    if table is None:
        table = materialize(df, name)
        if _SHARED:
            _SHARED[-1].append((df.semanticHash(), df, table))
    return table


def stored_before(df: DataFrame) -> DataFrame | None:
    """The table that ``stored_once`` made of an equal plan in an open scope of ``shared_tables``, if any."""
    mark = df.semanticHash() if _SHARED else None
    for scope in reversed(_SHARED):
        for known, plan, table in scope:
            if known == mark and plan.sameSemantics(df):
                return table
    return None


def sharing() -> bool:
    """Whether a scope of ``shared_tables`` is open."""
    return bool(_SHARED)


def wide_scan(table: DataFrame, key: str) -> DataFrame:
    """Spread a stored table over all cores where its files give fewer splits than that.

    For use before a step that multiplies rows. Large tables have more splits than cores and stay as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


def hot_keys(rows: DataFrame, on: list[str], block: int, out: str, sizes: DataFrame | None = None) -> DataFrame | None:
    """Keys that more than ``block`` rows share, with the number of blocks they need; None if there are none.

    ``sizes`` (key columns and ``_rows``) saves the count where it is known. At most ``rows / block`` keys qualify.
    They are written out, so a later join broadcasts them only if their measured size is below Spark's threshold.
    """
    if sizes is None:
        sizes = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = sizes.where(F.col("_rows") > block).select(*on, F.ceil(F.col("_rows") / F.lit(block)).cast("int").alias(out))
    hot = materialize(hot, "hot")
    return None if hot.isEmpty() else hot


def spread_join(left: DataFrame, right: DataFrame, on: list[str], condition: Column | None = None,
                block: int = BLOCK, right_sizes: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Inner many-to-many equi-join in which no task gets a whole hot key.

    Where a key has more than ``block`` rows on a side, that side is cut into blocks by a hash of the row and the
    other side is repeated once per block, so a key with l and r rows becomes ceil(l/block) * ceil(r/block)
    independent keys. Other keys are neither cut nor repeated. Both inputs should be stored tables, since they are
    counted first; their other columns must have different names. With ``unique`` the right side has
    every key once.
    """
    hot_left = hot_keys(left, on, block, "_lblocks")
    hot_right = None if unique else hot_keys(right, on, block, "_rblocks", right_sizes)
    return _spread(left, right, on, condition, hot_left, hot_right)


def self_pairs(rows: DataFrame, on: list[str], item: str, carry: tuple[str, ...] = (),
               condition: Column | None = None, block: int = BLOCK, sizes: DataFrame | None = None) -> DataFrame:
    """Pairs ``item_a < item_b`` of rows that share ``on``; carried columns get the suffixes ``_a`` and ``_b``.

    Cut into blocks like ``spread_join``: a hot group is spread over as many keys as it has block pairs.
    """
    hot = hot_keys(rows, on, block, "_lblocks", sizes)
    left = rows.select(*on, *[F.col(c).alias(f"{c}_a") for c in (item, *carry)])
    right = rows.select(*on, *[F.col(c).alias(f"{c}_b") for c in (item, *carry)])
    ordered = F.col(f"{item}_a") < F.col(f"{item}_b")
    condition = ordered if condition is None else ordered & condition
    hot_right = None if hot is None else hot.withColumnRenamed("_lblocks", "_rblocks")
    return _spread(left, right, on, condition, hot, hot_right)


def _spread(left, right, on, condition, hot_left, hot_right):
    keys = list(on)
    if hot_left is not None or hot_right is not None:
        left = _blocked(left, on, hot_left, hot_right, "_lblocks", "_rblocks", "_lblock", "_rblock")
        right = _blocked(right, on, hot_right, hot_left, "_rblocks", "_lblocks", "_rblock", "_lblock")
        keys += ["_lblock", "_rblock"]
    joined = left.join(right, keys, "inner")
    if condition is not None:
        joined = joined.where(condition)
    return joined.drop("_lblock", "_rblock")


def _blocked(rows, on, own, other, own_blocks, other_blocks, own_block, other_block):
    one = F.lit(1).cast("int")
    picked = F.xxhash64(*[F.col(c) for c in rows.columns])
    for hot in (own, other):
        if hot is not None:
            rows = rows.join(hot, on, "left")
    n_own = F.coalesce(F.col(own_blocks), one) if own is not None else one
    n_other = F.coalesce(F.col(other_blocks), one) if other is not None else one
    rows = rows.withColumn(own_block, F.pmod(picked, n_own.cast("bigint")).cast("int"))
    rows = rows.withColumn(other_block, F.explode(F.sequence(F.lit(0).cast("int"), n_other - one)))
    return rows.drop(own_blocks, other_blocks)
