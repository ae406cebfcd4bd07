"""Merkle manifest of a dataset by time-forward processing: digests travel up and proofs down as messages to labelled nodes.

A row is a leaf. The leaves of a source stand in order of id, and every ``fanout`` consecutive nodes become one, level by level,
until one is left, the source's subroot; the subroots, in order of source, become the root in the same way. Nodes carry labels that
put every child before its parent. A node is worked on when its label comes up: it takes the messages that its children
left in a priority queue ordered by label, and leaves its own digest there for its parent. In the reversed sweep each node takes what
its parent left for it, the proof of the parent, and leaves for each child the siblings' digests followed by that proof.

The queue is external. Messages that cross from one block of ``fanout ** LEVELS`` nodes to another go through a stored
table that Spark deals by block and sorts by label, spilling to disk; inside a block, where a sweep never holds more than ``fanout``
messages a level, a heap does. So the first sweep takes a pass for every ``LEVELS`` levels, each over ``fanout ** LEVELS`` times
fewer rows than the one before, and the reversed sweep the same number; no task and no driver holds a tree. Blocks of a large
source are dealt over all tasks.

Places of leaves are exact: rows are range-partitioned by source, id and digest, numbered inside each partition, and the numbers of
earlier partitions are added from one row a source and partition.

Defined results. A null value is written ``-``, an empty text ``0:``. Null sources come first, null ids first in their source; rows
of one id are ordered by leaf digest, and rows equal in all columns are leaves of their own. Columns that aren't listed in ``columns``
don't matter. Rows with a null id are not tampered with. An empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.operators.staging import materialize

FANOUT = 16
LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_AT_ONCE = 4096


def digest(text: str) -> str:
    """Lower-case hexadecimal SHA-256."""
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    written = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
               for v in values]
    return F.sha2(F.concat(*written).cast("binary"), 256)


# --- the sweeps inside a block

def block_nodes(leaves: list[str], levels: int, fanout: int = FANOUT) -> list[list[str]]:
    """Digests of all levels above ``leaves``, from the lowest; a level's nodes in order.

    Time-forward: a node's label is (its last leaf, its level), so it comes up right after its last child. Messages are (label, sender's place, digest).
    """
    above: list[list[str]] = [[] for _ in range(levels)]
    if not levels:
        return above
    last = len(leaves) - 1
    queue: list[tuple[tuple[int, int], int, str]] = []

    def send(level: int, place: int, value: str) -> None:
        """To the parent of a node, which is one level up."""
        span = fanout ** (level + 1)
        end = min((place // fanout + 1) * span - 1, last)
        heapq.heappush(queue, ((end, level + 1), place, value))

    for place, value in enumerate(leaves):
        send(0, place, value)
        while queue and queue[0][0][0] <= place:
            label, parts = queue[0][0], []
            while queue and queue[0][0] == label:
                parts.append(heapq.heappop(queue)[2])
            level = label[1]
            above[level - 1].append(digest("".join(parts)))
            if level < levels:
                send(level, len(above[level - 1]) - 1, above[level - 1][-1])
    return above


def fold(value: str, path: list[tuple[int, str]]) -> str:
    """The root that follows from a digest and its path: at each level the place in the run and the siblings' digests."""
    for place, siblings in path:
        cut = 64 * place
        value = digest(siblings[:cut] + value + siblings[cut:])
    return value


def block_paths(leaves: list[str], above: list[list[str]], path: list[tuple[int, str]], fanout: int = FANOUT):
    """Reversed sweep: yields for every leaf ``(path, parent, top)``.

    ``path`` leads to the root of the whole tree, ``parent`` is the digest one level up and ``top`` the root that follows from it; a
    block of one leaf on the highest level has no parent, and ``top`` follows from the leaf. The given ``path`` is that of the block's own
    node. A node's message to its children is its path and the root that follows from its digest.
    """
    if not above:
        yield path, None, fold(leaves[0], path)
        return
    messages = [(path, fold(above[-1][0], path))]
    for level in range(len(above) - 1, -1, -1):
        below = above[level - 1] if level else leaves
        sent = []
        for place, child in enumerate(below):
            parent, own = divmod(place, fanout)
            run = below[parent * fanout: (parent + 1) * fanout]
            up, top = messages[parent]
            own_path = [(own, "".join(run[:own]) + "".join(run[own + 1:])), *up]
            if level:
                sent.append((own_path, fold(child, own_path)))
            else:
                yield own_path, above[0][parent], top
        messages = sent


# --- over the rows

def numbered(nodes: DataFrame, tree: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Adds ``place`` (from 0, in ``order``, nulls first) and ``nodes`` (their number) within each value of ``tree``; stored.

    Rows equal in ``tree`` and ``order`` are told by a number of the stored row, so a large group of them is spread, too.
    """
    stored = materialize(nodes, "nodes").withColumn("_row", F.monotonically_increasing_id())
    keys = [tree, *order, "_row"]
    ranged = stored.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys]).sortWithinPartitions(
        *[F.col(k).asc_nulls_first() for k in keys])
    at = stored.columns.index(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, here, number = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for value in batch.column(at).to_pylist():
                if (value,) != here:
                    here, number = (value,), 0
                places.append(number)
                number += 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([part] * len(places), pa.int32()),
                                              pa.array(places, pa.int64())], names=[*batch.schema.names[:-1], "_part", "_inside"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields[:-1]) + ", _part int, _inside long"
    counted = materialize(ranged.mapInArrow(count, schema), "counted")
    sizes = counted.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each tree and partition that holds a piece of it
    starts = sizes.select(F.col(tree).alias("_tree"), F.col("_part").alias("_at"),
                          F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long")).alias("_start"),
                          F.sum("_size").over(whole).alias("nodes"))
    placed = counted.join(starts, (F.col("_part") == F.col("_at")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return placed.withColumn("place", F.col("_start") + F.col("_inside")).drop("_part", "_inside", "_at", "_tree", "_start")


def _heights(nodes: Column, fanout: int) -> Column:
    """Number of levels above ``nodes`` leaves until one is left; whole numbers, up to 2 ** 62."""
    found = F.lit(0)
    span = 1
    while span * fanout < 1 << 62:
        found = found + (nodes > F.lit(span)).cast("int")
        span *= fanout
    return found


def up_sweep(placed: DataFrame, tree: str, levels: int = LEVELS, fanout: int = FANOUT, carry: tuple[str, ...] = ()) -> list[DataFrame]:
    """Blocks of every pass over ``placed (tree, place, nodes, digest, carried columns)``, stored, the lowest first.

    A block: ``tree, block`` (its number in the tree), ``height`` (levels it covers), ``nodes`` (of its tree, on this level), ``top`` and
    its leaves' digests and carried values as arrays. In the last table every tree has one block.
    """
    span = fanout ** levels
    passes, rows = [], placed.select(tree, "place", "nodes", "digest", *carry)
    while True:
        dealt = rows.withColumn("block", F.call_function("div", "place", F.lit(span).cast("long")))
        dealt = dealt.withColumn("height", F.least(_heights(F.col("nodes"), fanout), F.lit(levels)))
        dealt = dealt.repartition(tree, "block").sortWithinPartitions(F.col(tree).asc_nulls_first(), "block", "place")
        kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
        names = [tree, "block", "nodes", "height", "top", "digest", *carry]
        schema = (f"`{tree}` {kinds[tree]}, block long, nodes long, height int, top string, digest array<string>"
                  + "".join(f", `{c}` array<{kinds[c]}>" for c in carry))
        blocks = materialize(dealt.select(*names[:4], "digest", *carry).mapInArrow(
            _block_maker(names, 4, fanout), schema), "blocks")
        passes.append(blocks)
        if blocks.where(F.col("nodes") > span).isEmpty():
            return passes
        rows = blocks.select(tree, F.col("block").alias("place"), F.ceil(F.col("nodes") / F.lit(span)).cast("long").alias("nodes"),
                             F.col("top").alias("digest"))
        carry = ()


def _block_maker(names: list[str], fixed: int, fanout: int) -> Callable:
    """Sorted rows of blocks to a row a block; a block has at most fanout ** levels rows, so it fits in memory."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, types = None, [], None

        def block() -> pa.RecordBatch:
            columns = [pa.concat_arrays([h[k] for h in held]) for k in range(len(types))]
            leaves = columns[0].to_pylist()
            above = block_nodes(leaves, key[3], fanout)
            top = above[-1][0] if above else leaves[0]
            ends = pa.array([0, len(leaves)], pa.int32())
            fields = [pa.array([v], t) for v, t in zip(key, key_types, strict=True)] + [pa.array([top])]
            return pa.RecordBatch.from_arrays(fields + [pa.ListArray.from_arrays(ends, c) for c in columns], names=names)

        for batch in batches:
            types = [batch.schema.field(k).type for k in range(fixed, batch.num_columns)]
            key_types = [batch.schema.field(k).type for k in range(fixed)]
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(fixed)), strict=True))
            start = 0
            for k in range(1, len(keys) + 1):
                if k < len(keys) and keys[k] == keys[start]:
                    continue
                if keys[start] != key:
                    if held:
                        yield block()
                    key, held = keys[start], []
                held.append([batch.column(c).slice(start, k - start) for c in range(fixed, batch.num_columns)])
                start = k
        if held:
            yield block()

    return make


def down_sweep(passes: list[DataFrame], tree: str, messages: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """The blocks of the lowest pass, each with the message for its own node: ``places, siblings, roots``.

    ``messages (tree, block, places, siblings, roots)`` has those of the trees' tops (``roots`` is handed on as it is); each pass sends
    them to its leaves, which are the blocks of the pass below.
    """
    span = fanout ** levels
    for blocks in reversed(passes[1:]):
        kind = blocks.schema[tree].dataType.simpleString()
        names = [tree, "block", "places", "siblings", "roots"]

        def send(batches: Iterator[pa.RecordBatch], names=names) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types = [batch.schema.field(n).type for n in names]
                for at in _each(batch):
                    out, first = [], at["block"] * span
                    for place, (path, _, _) in enumerate(_paths(at, fanout)):
                        out.append((at[names[0]], first + place, [p for p, _ in path], [s for _, s in path], at["roots"]))
                        if len(out) == ROWS_AT_ONCE:
                            yield _batch(out, types, names)
                            out = []
                    if out:
                        yield _batch(out, types, names)

        messages = materialize(_with_messages(blocks, tree, messages).select(*names, "height", "digest").mapInArrow(
            send, f"`{tree}` {kind}, block long, places array<int>, siblings array<string>, roots array<string>"), "messages")
    return _with_messages(passes[0], tree, messages)


def _with_messages(blocks: DataFrame, tree: str, messages: DataFrame) -> DataFrame:
    given = messages.select(F.col(tree).alias("_tree"), F.col("block").alias("_block"), "places", "siblings", "roots")
    return blocks.join(given, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: a row holds a block."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _paths(row: dict, fanout: int):
    """``block_paths`` of a block with its message."""
    path = list(zip(row["places"], row["siblings"], strict=True))
    return block_paths(row["digest"], block_nodes(row["digest"], row["height"], fanout), path, fanout)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=names)


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", columns: tuple[str, ...] = COLUMNS, text: str = "text",
             tampered_every: int = TAMPERED_EVERY, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row of ``docs``.

    ``columns`` are the values that a leaf holds. ``proof_sha256`` is the digest of the siblings on the way to the root. Of rows
    whose id's checksum ``tampered_every`` divides, the digest of the lower-cased text is folded with the siblings, of others their own; ``verified``
    tells whether that gives the root.
    """
    lower = F.translate(F.col(text), UPPER, LOWER)
    chosen = F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(tampered_every) == 0
    changed = F.when(chosen & (lower != F.col(text)), leaf_digest(*[lower if c == text else F.col(c) for c in columns]))
    leaves = docs.select(F.col(source).cast("string").alias("tree"), F.col(doc_id).alias("doc_id"),
                         leaf_digest(*[F.col(c) for c in columns]).alias("digest"), changed.alias("changed"))
    lowest = up_sweep(numbered(leaves, "tree", ["doc_id", "digest"]), "tree", levels, fanout, ("doc_id", "changed"))
    subroots = lowest[-1].select(F.lit("").alias("all"), "tree", F.col("top").alias("digest"))
    highest = up_sweep(numbered(subroots, "all", ["tree"]), "all", levels, fanout, ("tree",))
    top = highest[-1].select("all", F.col("block"), F.array().cast("array<int>").alias("places"),
                             F.array().cast("array<string>").alias("siblings"), F.array("top").alias("roots"))

    def to_sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "block", "places", "siblings", "roots"]
        types = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in batches:
            for at in _each(batch):
                rows = [(tree, 0, [p for p, _ in path], [s for _, s in path], [leaf, *at["roots"]])
                        for tree, leaf, (path, _, _) in zip(at["tree"], at["digest"], _paths(at, fanout), strict=True)]
                yield _batch(rows, types, names)

    messages = down_sweep(highest, "all", top, levels, fanout).select("tree", "height", "digest", "places", "siblings", "roots")
    messages = materialize(messages.mapInArrow(
        to_sources, "tree string, block long, places array<int>, siblings array<string>, roots array<string>"), "messages")
    blocks = down_sweep(lowest, "tree", messages, levels, fanout).select(
        "doc_id", "changed", "height", "digest", "places", "siblings", "roots")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field("doc_id").type.value_type, *[pa.string()] * 5, pa.bool_()]
            for at in _each(batch):
                out, (subroot, root) = [], at["roots"]
                for doc, leaf, changed, (path, parent, top) in zip(at["doc_id"], at["digest"], at["changed"], _paths(at, fanout),
                                                                    strict=True):
                    if parent is None:
                        folded = top if changed is None else fold(changed, path)
                    else:
                        value = fold(changed or leaf, path[:1])
                        folded = top if value == parent else fold(value, path[1:])
                    out.append((doc, leaf, subroot, root, digest("".join(s for _, s in path)), folded, folded == root))
                yield _batch(out, types, names)

    kind = docs.schema[doc_id].dataType.simpleString()
    return blocks.mapInArrow(to_rows, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                      "folded_root string, verified boolean")
