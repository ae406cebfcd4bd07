"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The documents of a source are dealt over shards by a seeded hash and lined up inside each in hash order. A source has as many shards as
its own documents with words ask for, so a small one has a single shard however large the table is. Read twice over, that line
is cut into blocks of ``block`` words. The words of the whole mix make a number of blocks; they are allocated to sources, and
those of a source to its shards, by highest quotients (votes over 1, 3, 5, ...). So each shard knows how many blocks to give before
any is picked, and no step sees more than one row per shard of a source. From the first pass of its line, and once that is used up
from the second, a shard then picks its quota of blocks, evenly spaced from a seeded start, in the seeded order of the documents.
How many of the first j blocks are picked is a formula, so no block becomes a row.

Rows that can't be told apart are lined up as one entry with a number of copies, so a large group of them is one row until its copies
have their places.
"""

from __future__ import annotations

from heapq import heapify, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.common import expanded, row_key, running_totals, text_of, unused
from affinis.operators.staging import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 32
SHARD_DOCS = 8192
BUCKET_DOCS = 64
SEED = 17
WORD = "[^\\x20\\x09-\\x0D]+"


def words_of(column: str = "text") -> Column:
    """Number of words: runs of anything but blanks, tabs and line ends; null: 0."""
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(votes: np.ndarray, most: np.ndarray, seats: int) -> np.ndarray:
    """Seats for each party by highest quotients votes / (2k + 1), at most ``most`` each; ties go to the earlier party."""
    votes, most = np.asarray(votes, float), np.where(np.asarray(votes) > 0, most, 0).astype(np.int64)
    seats = int(min(seats, most.sum()))
    given = np.zeros(len(votes), np.int64)
    if not seats:
        return given

    def at(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(np.minimum(votes / divisor + 0.5, 2.0 ** 62)).astype(np.int64))

    low, high = votes.sum() / (seats + len(votes)), votes.max() * 2 + 1
    while at(low).sum() <= seats and low > 1e-300:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    # one seat less than the divisor gives is safe from rounding; the rest go one by one
    given = np.maximum(at(high) - 1, 0)
    queue = [(-votes[i] / (2 * int(given[i]) + 1), i) for i in range(len(votes)) if given[i] < most[i]]
    heapify(queue)
    for _ in range(seats - int(given.sum())):
        quotient, i = queue[0]
        given[i] += 1
        heapreplace(queue, (-votes[i] / (2 * int(given[i]) + 1) if given[i] < most[i] else 1.0, i))
    return given


def _seat(rows: pd.DataFrame, order: str) -> pd.DataFrame:
    rows = rows.sort_values(order, na_position="last", kind="stable")
    return rows.assign(quota=sainte_lague(rows["votes"].to_numpy(), rows["most"].to_numpy(), int(rows["seats"].iloc[0])))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``rank`` (0-based, by code point, null last), ``weight`` and ``target`` to ``(source, source_size)``, one row per source.

    Targets share ``share`` of all sizes by weight and stop at ``most`` times the source's size; the excess goes to the others by weight.
    Sources stop in the order of size over weight, so running sums in that order find all that do.
    """
    size = F.col("source_size")
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long"))
    whole = Window.partitionBy()
    earlier = Window.orderBy(size / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    left = F.lit(share) * F.sum(size).over(whole) - most * F.coalesce(F.sum(size).over(earlier), zero)
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), zero)
    ranked = ranked.withColumn("stops", left * F.col("weight") >= (most * size * open_weight).cast("double"))
    free = F.lit(share) * F.sum(size).over(whole) - most * F.sum(F.when(F.col("stops"), size).otherwise(0)).over(whole)
    rate = free / F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("stops"), (most * size).cast("double")).otherwise(rate * F.col("weight"))
    return ranked.withColumn("target", target).drop("stops")


def _picked(j: Column, shard: dict[str, Column] | None = None) -> Column:
    """Blocks picked among the first ``j`` of a shard, in whole numbers."""
    names = ("blocks", "blocks1", "pick1", "pick2", "start1", "start2")
    blocks, blocks1, pick1, pick2, start1, start2 = ((shard or {}).get(n, F.col(n)) for n in names)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    first = F.call_function("div", j * pick1 + start1, F.greatest(blocks1, one))
    second = F.call_function("div", (j - blocks1) * pick2 + start2, F.greatest(blocks - blocks1, one))
    return F.when(j <= blocks1, F.when(blocks1 > 0, first).otherwise(none)).otherwise(pick1 + second)


def _words_to(position: Column, block: int) -> Column:
    """Words picked before a position of a shard's line."""
    j = F.least(F.call_function("div", position, F.lit(block).cast("long")), F.col("blocks"))
    # nothing is picked of what is left behind the last block
    inside = F.when(j < F.col("blocks"), (position - j * block) * (_picked(j + 1) - _picked(j))).otherwise(F.lit(0).cast("long"))
    return _picked(j) * block + inside


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK,
             seed: int = SEED, shard_docs: int = SHARD_DOCS, carry: str | None = None, **targets) -> DataFrame:
    """The mix, one row per row of ``docs``: ``doc_id, source, size, source_size, target, shard, quota, taken`` and what it is made of.

    ``taken`` is the number of the document's words in the mix, repeats counted; it is at most twice its size. The words of a
    source miss its target by less than a block for every shard, one a ``shard_docs`` of its documents with words. Documents without words take none. Null texts have size 0, a
    null source is a source, repeated rows are documents of their own. The mix depends on ids, texts and the seed only.
    ``carry`` names a column that is handed on as ``carried``; ``copies`` tells how many rows are equal in all that is used here.
    """
    carried = [F.col(carry).alias("carried")] if carry else []
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                             F.md5(text_of(text).cast("binary"))))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words_of(text).alias("size"),
                       mark.alias("mark"), *carried)
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    rows = materialize(rows.withColumn("whole", F.col("size") * F.col("copies")), "sized")
    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    sums = rows.groupBy("source").agg(F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).alias("docs"),
                                      F.sum("copies").alias("rows"), F.max("copies").alias("most"))
    sums = materialize(sums, "source-rows")
    known = sums.agg(F.sum("rows"), F.max("most")).first()
    spread = max(1, -(-(known[0] or 0) // shard_docs))
    # a source of up to shard_docs documents has one shard, so there is at most one row here for so many documents
    large = F.broadcast(sums.where(F.col("docs") > shard_docs).select(
        F.col("source").alias("s"), F.ceil(F.col("docs") / shard_docs).cast("long").alias("shards")))
    line = rows.join(large, F.col("source").eqNullSafe(F.col("s")), "left")
    # documents without words take none wherever they are; they are kept out of the shards of the others
    shard = F.when(F.col("size") > 0, number % F.coalesce("shards", F.lit(1).cast("long"))).otherwise(-1 - number % spread)
    line = line.withColumn("shard", shard).drop("s", "shards")
    cells = line.groupBy("source", "shard").agg(F.sum("whole").alias("cell"))
    cells = materialize(cells, "cells")
    sources = source_targets(cells.groupBy("source").agg(F.sum("cell").alias("source_size")), **targets)
    room = cells.withColumn("most", F.call_function("div", 2 * F.col("cell"), F.lit(block).cast("long")))
    most = room.groupBy(F.col("source").alias("s")).agg(F.sum("most").alias("most"))
    sources = sources.join(most, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    seats = F.floor(F.sum("target").over(Window.partitionBy()) / block + 0.5).cast("long")
    sources = sources.withColumn("votes", F.col("target")).withColumn("seats", seats)
    by_source = sources.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda rows: _seat(rows, "rank")[["source", "source_size", "target", "quota"]],
        "source string, source_size long, target double, quota long")
    by_source = materialize(by_source, "source-quotas").withColumnRenamed("quota", "seats").withColumnRenamed("source", "s")
    votes = room.join(by_source, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("votes", F.col("cell").cast("double"))
    quotas = votes.groupBy("source").applyInPandas(
        lambda rows: _seat(rows, "shard")[["source", "shard", "cell", "most", "source_size", "target", "quota"]],
        "source string, shard long, cell long, most long, source_size long, target double, quota long")
    length = F.lit(block).cast("long")
    quotas = quotas.withColumnRenamed("most", "blocks").withColumn("blocks1", F.call_function("div", "cell", length))
    quotas = quotas.withColumn("pick1", F.least("quota", "blocks1")).withColumn("pick2", F.col("quota") - F.col("pick1"))
    for k, of in (("1", F.col("blocks1")), ("2", F.col("blocks") - F.col("blocks1"))):
        start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}/{k}"), F.coalesce("source", F.lit("null")),
                                                     F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
        quotas = quotas.withColumn(f"start{k}", F.when(of > 0, start % of).otherwise(0).cast("long"))
    quotas = materialize(quotas, "shard-quotas").withColumnsRenamed({"source": "s", "shard": "h"})

    buckets = max(1, shard_docs // BUCKET_DOCS)
    line = line.withColumn("bucket", F.call_function("div", F.conv(F.substring("mark", 9, 8), 16, 10).cast("long") * buckets,
                                                     F.lit(1 << 32)))
    placed = running_totals(line, ["source", "shard"], "bucket", ["mark", "size", *(["carried"] if carry else [])], {"whole": "at"})
    placed = expanded(placed, "copies", "copy", known[1] or 0).withColumn("at", F.col("at") + F.col("copy") * F.col("size")).drop("copy")
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h"))).drop("s", "h")
    at, size, cell = F.col("at"), F.col("size"), F.col("cell")
    first = _words_to(at + size, block) - _words_to(at, block)
    second = _words_to(cell + at + size, block) - _words_to(cell + at, block)
    return placed.withColumns({"taken1": first, "taken2": second, "taken": first + second})


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK,
        **options) -> DataFrame:
    """The texts of the mix: for each document and pass over its source one row with the words taken, in the columns of ``docs``.

    A wholly taken text stays as it is; of others the picked blocks follow each other, each word with the blanks after it. Rows of
    which nothing is taken are left out. ``n_chars``, if there, tells the new length. All other columns are as given.
    """
    row, pass_ = unused(docs, "_mix_row"), unused(docs, "_mix_pass")
    keyed = docs.withColumn(row, row_key(docs, text))
    plan = plan_mix(keyed, doc_id, source, text, block, carry=row, **options)
    state = ["blocks", "blocks1", "pick1", "pick2", "start1", "start2"]
    passes = F.array(F.struct(F.col("at"), F.col("taken1").alias("taken")),
                     F.struct((F.col("cell") + F.col("at")).alias("at"), F.col("taken2").alias("taken")))
    parts = plan.select(F.col("carried").alias(row), F.explode(passes).alias("part"), "size", "copies", *state)
    parts = parts.where("part.taken > 0").select(row, F.struct("part.at", "part.taken", "size", *state).alias(pass_), "copies")
    parts = materialize(parts, "mix-parts")
    repeated = parts.where("copies > 1").select(row).distinct()
    parts = parts.drop("copies")
    if repeated.isEmpty():
        mixed = keyed.join(parts, row)
    else:  # of equal rows one meets the parts of all
        mixed = keyed.join(repeated, row, "left_anti").unionByName(
            keyed.join(repeated, row, "left_semi").dropDuplicates([row])).join(parts, row)
    taken = {c: F.col(pass_)[c] for c in ("at", "taken", "size", *state)}

    def picked(word: Column, k: Column) -> Column:
        j = F.call_function("div", taken["at"] + k.cast("long"), F.lit(block).cast("long"))
        return (j < taken["blocks"]) & (_picked(j + 1, taken) > _picked(j, taken))  # the rest behind the last block stays out

    words = F.regexp_extract_all(F.col(text), F.lit(WORD + "[\\x20\\x09-\\x0D]*"), F.lit(0))
    cut = F.when(taken["taken"] == taken["size"], F.col(text)).otherwise(F.array_join(F.filter(words, picked), ""))
    mixed = mixed.withColumn(text, cut)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)
