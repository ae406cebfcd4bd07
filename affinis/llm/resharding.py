"""Resharding by minimum-cost flow: new shard capacities are met with the fewest bytes moved.

The old shards' sizes are supplies, the new shards' capacities demands; a byte that stays in its shard costs 0, one that moves costs 1.
The flow that satisfies all at least cost says how many bytes each old shard keeps and sends to each other one. The network
has one node a shard; its size is set by the shard numbers, not by the data.

The rows of an old shard are lined up from large to small; the line is cut at the flow's amounts, the part that stays first. A row
goes where its middle falls. So the cuts fall among small rows, and each shard misses its capacity by about one small row a cut.
Places in the line are running totals over small buckets of narrow rows, so no shard is ever ordered as a whole, and rows that can't be
told apart are one entry with a number of copies.

The cuts become boundary keys, at most one for each pair of shards: a row's place in the line follows from its own columns, so its new
shard does, too, without a join. Groups of equal rows that a cut falls into are told by their keys and split by count. Rows are
then dealt by new shard, once, and numbered in pieces whose sizes are known from the narrow rows.

Then the affected shards are written anew, each row once. The result is taken from the files, read back.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm.common import expanded, row_key, running_totals, text_of, unused
from affinis.operators.staging import materialize, staging_root

OLD_SHARDS, SHARDS = 32, 40
ROW_BYTES = 16
BUCKET_ROWS = 4096
PIECE_ROWS, FILE_ROWS = 4096, 100_000


def min_cost_flow(supplies: list[int], demands: list[int], cost) -> tuple[dict[tuple[int, int], int], int]:
    """Amounts ``(i, j) -> flow`` that bring all supplies to the demands (equal sums) at least total ``cost(i, j)``, and that cost.

    Successive shortest paths with potentials; costs must not be negative.
    """
    if sum(supplies) != sum(demands):
        raise ValueError("supplies and demands differ in sum")
    n, m = len(supplies), len(demands)
    source, sink = n + m, n + m + 1
    edges: list[list] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, capacity: int, price: int) -> None:
        out[a].append(len(edges))
        edges.append([b, capacity, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, amount in enumerate(supplies):
        edge(source, i, amount, 0)
    whole = sum(supplies)
    first = len(edges)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, whole, cost(i, j))
    for j, amount in enumerate(demands):
        edge(n + j, sink, amount, 0)
    potential, total = [0] * (n + m + 2), 0
    while True:
        far: list[float] = [float("inf")] * (n + m + 2)
        by = [-1] * (n + m + 2)
        far[source] = 0
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, capacity, price = edges[e]
                if capacity and d + price + potential[a] - potential[b] < far[b]:
                    far[b] = d + price + potential[a] - potential[b]
                    by[b] = e
                    heapq.heappush(queue, (far[b], b))
        if by[sink] < 0:
            break
        for a, d in enumerate(far):
            if d < float("inf"):
                potential[a] += d
        amount, a = whole, sink
        while a != source:
            amount = min(amount, edges[by[a]][1])
            a = edges[by[a] ^ 1][0]
        a = sink
        while a != source:
            edges[by[a]][1] -= amount
            edges[by[a] ^ 1][1] += amount
            total += amount * edges[by[a]][2]
            a = edges[by[a] ^ 1][0]
    flow = {(i, j): edges[first + 2 * (i * m + j) + 1][1] for i in range(n) for j in range(m)}
    return {k: v for k, v in flow.items() if v}, int(total)


def equal_capacities(total: int, shards: int) -> list[int]:
    """Whole numbers that differ by one at most and add up to ``total``."""
    return [total * (k + 1) // shards - total * k // shards for k in range(shards)]


def row_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) and a fixed overhead."""
    return (F.octet_length(text_of(text)) + ROW_BYTES).cast("long")


def plan_transfers(sizes: dict[int, int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes that go from each old shard (its number is its place among the new ones) to each new shard."""
    old = sorted(sizes)
    flow, _ = min_cost_flow([sizes[s] for s in old], capacities, lambda i, j: int(old[i] != j))
    return {(old[i], j): amount for (i, j), amount in flow.items()}


class Placement:
    """Where the rows of ``docs`` go: rows with their columns chosen by the caller, and the shards that give or get rows.

    Rows with equal columns can't be told apart; a group of them that a cut falls into, or that has more than ``piece_rows`` rows, is told by its
    key, and one of its rows is repeated as often as each shard gets.
    """

    def __init__(self, docs: DataFrame, old: Column, shards: int = SHARDS, text: str = "text", bucket_rows: int = BUCKET_ROWS,
                 piece_rows: int = PIECE_ROWS):
        spark = docs.sparkSession
        self.inner = {c: f"_doc{k}" for k, c in enumerate(docs.columns)}  # names that clash with nothing here
        rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in self.inner.items()], old.cast("int").alias("_old"),
                           row_key(docs, text).alias("_key"), row_bytes(text).alias("_size"))
        mark = F.md5(F.concat(F.col("_key.fp"), F.col("_key.rest").cast("string").cast("binary")))
        rows = rows.withColumn("_mark", mark).drop("_key")
        narrow = rows.groupBy("_old", "_size", "_mark").agg(F.count(F.lit(1)).alias("copies"))
        narrow = materialize(narrow.withColumn("whole", F.col("_size") * F.col("copies")), "sized")
        found = narrow.groupBy("_old").agg(F.sum("whole").alias("size"), F.sum("copies").alias("rows")).collect()  # a row a shard
        sizes = {r["_old"]: r["size"] for r in found}
        transfers = plan_transfers(sizes, equal_capacities(sum(sizes.values()), shards)) if sizes else {}
        most = max((r["rows"] for r in found), default=0)

        def part(count: int) -> Column:
            return F.call_function("div", F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long") * count, F.lit(1 << 32))

        # large rows first: by power of two, then by hash
        slices, self.pieces = max(1, -(-most // bucket_rows)), part(max(1, -(-most // piece_rows)))
        bucket = part(slices) - F.length(F.bin("_size")).cast("long") * slices
        line = running_totals(narrow.withColumn("_bucket", bucket), ["_old"], "_bucket", ["_mark", "_size"], {"whole": "at"})
        cuts, ends = [], dict.fromkeys(sizes, 0)
        for i, j in sorted(transfers, key=lambda k: (k[0], k[0] != k[1], k[1])):
            cuts.append((i, j, ends[i], ends[i] + transfers[i, j]))
            ends[i] += transfers[i, j]
        # at most one row for each pair of an old and a new shard
        cuts = F.broadcast(spark.createDataFrame(cuts, "_of int, _shard int, _from long, _to long"))

        def before(end: str) -> Column:
            """Copies whose middle lies before an end."""
            count = F.ceil((F.col(end) * 2 - F.col("_size") - F.col("at") * 2) / (F.col("_size") * 2))
            return F.least(F.greatest(count, F.lit(0)), F.col("copies")).cast("long")

        overlap = (F.col("at") + F.col("whole") > F.col("_from")) & (F.col("at") < F.col("_to"))
        share = line.join(cuts, (F.col("_old") == F.col("_of")) & overlap)
        share = share.withColumn("given", before("_to") - before("_from")).where("given > 0")
        share = share.withColumn("told", (F.col("given") < F.col("copies")) | (F.col("copies") > piece_rows))
        share = materialize(share.select("_old", "_size", "_mark", "_bucket", "_shard", "given", "told"), "shares")
        place = F.struct("_bucket", "_mark", "_size")
        bounds = share.where("not told").groupBy("_old", "_shard").agg(F.min(place).alias("low"), F.max(place).alias("high"))
        bounds = [(r["_old"], r["_shard"], tuple(r.low), tuple(r.high)) for r in bounds.collect()]  # as bounded as the cuts
        kind = "struct<_bucket: long, _mark: string, _size: long>"
        bounds = F.broadcast(spark.createDataFrame(bounds, f"_of int, _shard int, _low {kind}, _high {kind}"))
        told = materialize(share.where("told").select("_old", "_size", "_mark", "_shard", "given"), "told-groups")

        # rows of each piece: those of a told group go by the number of the copy, too
        piece = F.lit(piece_rows).cast("long")
        subs = F.when(F.col("told"), F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("given") - 1, piece))).otherwise(
            F.array(F.lit(0).cast("long")))
        counts = share.select("_old", "_shard", self.pieces.alias("_piece"), "told", "given", F.explode(subs).alias("_sub"))
        size = F.when(F.col("told"), F.least(piece, F.col("given") - F.col("_sub") * piece)).otherwise(F.col("given"))
        counts = counts.groupBy("_old", "_shard", "_piece", "_sub").agg(F.sum(size).alias("_rows"))
        earlier = Window.partitionBy("_shard").orderBy(F.col("_old") != F.col("_shard"), "_old", "_piece", "_sub").rowsBetween(
            Window.unboundedPreceding, -1)
        self.starts = materialize(counts.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("long"))), "pieces")
        moved = self.starts.where("_old <> _shard").select(F.explode(F.array("_old", "_shard")).alias("shard")).distinct()
        self.affected = sorted(r.shard for r in moved.collect())  # a number a shard

        rows = rows.withColumn("_bucket", bucket)
        inside = (F.col("_old") == F.col("_of")) & place.between(F.col("_low"), F.col("_high"))
        first = F.lit(0).cast("long").alias("_sub")
        kept = [*self.inner.values(), "_old", "_shard", "_mark"]
        if told.isEmpty():
            self.rows = rows.join(bounds, inside).select(*kept, first)
        else:
            keys = ["_old", "_size", "_mark"]
            groups = told.select(*[F.col(k).alias(f"{k}_told") for k in keys]).distinct()
            same = [F.col(k) == F.col(f"{k}_told") for k in keys]
            single = rows.join(groups, same, "left_anti").join(bounds, inside).select(*kept, first)
            one = rows.join(groups, same, "left_semi").dropDuplicates(keys).join(told, keys)
            split = expanded(one, "given", "_copy").withColumn("_sub", F.call_function("div", "_copy", piece))
            self.rows = single.unionByName(split.select(*kept, "_sub"))

    def select(self, *columns: Column, where: Column | None = None) -> DataFrame:
        """The columns (of ``inner`` names) of all rows, or of those ``where`` holds, with ``_old``, ``_shard`` and ``_slot``.

        Only these columns are dealt; each row is, once, to its piece of its new shard.
        """
        keys = ["_shard", "_old", "_piece", "_sub"]
        rows = self.rows.withColumn("_piece", self.pieces)
        rows = (rows if where is None else rows.where(where)).select(*columns, *keys, "_mark")
        number = F.row_number().over(Window.partitionBy(*keys).orderBy("_mark"))
        rows = rows.withColumn("_number", number).join(self.starts.drop("_rows").hint("merge"), keys)
        names = [c for c in rows.columns if c not in (*keys, "_mark", "_number", "_start")]
        return rows.select(*names, "_old", "_shard", (F.col("_start") + F.col("_number") - 1).alias("_slot"))

    def places(self, doc_id: str, text: str, carry: str | None = None, where: Column | None = None) -> DataFrame:
        """``doc_id, size, text_crc32, old_shard, shard, [carried,] slot``."""
        own = self.inner[text]
        columns = [F.col(self.inner[doc_id]).alias("doc_id"), row_bytes(own).alias("size"),
                   F.crc32(text_of(own).cast("binary")).alias("text_crc32"), *([F.col(self.inner[carry]).alias("carried")] if carry else [])]
        return self.select(*columns, where=where).select(
            "doc_id", "size", "text_crc32", F.col("_old").alias("old_shard"), F.col("_shard").alias("shard"),
            *(["carried"] if carry else []), F.col("_slot").alias("slot"))


def reshard(docs: DataFrame, old: Column, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
            bucket_rows: int = BUCKET_ROWS, carry: str | None = None) -> DataFrame:
    """New place of every row: ``doc_id, size, text_crc32, old_shard, shard, slot``.

    ``old`` gives the present shard, a whole number from 0 that every row has. ``slot`` numbers the rows of a new shard from 0 without gaps.
    Rows that stay and shards that neither give nor get rows are left where they are. Null texts have the size of the overhead and
    checksum 0, repeated rows are rows of their own, an empty table gives none. ``carry`` names a column that is handed on as
    ``carried``.
    """
    return Placement(docs, old, shards, text, bucket_rows).places(doc_id, text, carry)


def affected_shards(placed: DataFrame) -> list[int]:
    """New shards that get or give rows: those whose files are to be rewritten. At most one number a shard."""
    moved = placed.where("old_shard <> shard")
    both = moved.select("shard").unionByName(moved.select(F.col("old_shard").alias("shard"))).distinct()
    return sorted(r.shard for r in both.collect())


def rewrite(docs: DataFrame, placed: DataFrame, folder: str, doc_id: str = "doc_id", file_rows: int = 100_000,
            row: str | None = None) -> list[int]:
    """Write the affected shards of ``docs`` below ``folder`` (``shard=k``), in slot order, in files of ``file_rows`` rows; returns them.

    Each row is written once, with its slot. ``row`` names a column of ``docs`` that tells every row, which ``placed`` has as
    ``carried``; it isn't written. Without it rows are told by their ids, and a null or repeated id is an error.
    """
    shards = affected_shards(placed)
    if row is None:
        rows, ids = placed.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
        if rows != ids:
            raise ValueError(f"{rows} rows have {ids} different ids that are not null: name a column that tells the rows")
    places = placed.where(F.col("shard").isin(shards)).select(F.col("carried" if row else "doc_id").alias("_id"), "shard", "slot")
    whole = docs.join(places, F.col(row or doc_id) == F.col("_id")).drop("_id", *([row] if row else []))
    piece = F.call_function("div", F.col("slot"), F.lit(file_rows).cast("long"))
    whole.repartition("shard", piece).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return shards


def reshard_files(docs: DataFrame, old: Column, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
                  folder: str | None = None, file_rows: int = FILE_ROWS, **options) -> DataFrame:
    """The rows of ``reshard`` after the affected shards were written (to a new folder in the shared one, if none is given).

    Rows of affected shards come from the files, with sizes and checksums of the texts found there; the others from the placement. The
    files hold the columns of ``docs``, ``slot`` and, as their folder, ``shard``; where ``docs`` has such a column, an underscore goes before.
    """
    spark = docs.sparkSession
    placement = Placement(docs, old, shards, text, **options)
    affected, columns = placement.affected, ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot"]
    kept = placement.places(doc_id, text, where=~F.col("_shard").isin(affected)).select(*columns)
    if not affected:
        return kept
    folder = folder or f"{staging_root(spark)}/affinis/shards-{uuid.uuid4().hex}"
    slot, shard = unused(docs, "slot"), unused(docs, "shard")
    whole = [F.col(n).alias(n) for n in placement.inner.values()]
    moved = placement.select(*whole, where=F.col("_shard").isin(affected)).select(
        *[F.col(n).alias(c) for c, n in placement.inner.items()], F.col("_slot").alias(slot), F.col("_shard").alias(shard))
    moved.sortWithinPartitions(shard, slot).write.option("maxRecordsPerFile", file_rows).partitionBy(shard).parquet(folder)
    schema = T.StructType([*docs.schema.fields, T.StructField(slot, T.LongType()), T.StructField(shard, T.IntegerType())])
    back = spark.read.schema(schema).parquet(folder).select(
        F.col(doc_id).alias("doc_id"), row_bytes(text).alias("size"), F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        old.cast("int").alias("old_shard"), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
    return back if len(affected) == shards else kept.unionByName(back)
