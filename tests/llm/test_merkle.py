"""The manifest against a plain recursion, on odd rows, and with blocks small enough for many passes."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from affinis.llm import merkle
from tests.llm.test_operators import DOCS, odd_rows


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text=None):
    doc_id, own, lang, source, n_chars = row[:5]
    return h(*map(written, (doc_id, source, lang, n_chars, own if text is None else text)))


def reduced(nodes, fanout):
    """Root and, for every leaf, its (place, siblings) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            start = place // fanout * fanout
            run = nodes[start: start + fanout]
            paths[leaf].append((place - start, run[:place - start] + run[place - start + 1:]))
            at[leaf] = place // fanout
        nodes = [h(*nodes[k: k + fanout]) for k in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout=16):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: reduced([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in sources}
    root, above = reduced([tops[s][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        subroot, paths = tops[s]
        for x, path in zip(sorted(groups[s], key=lambda x: x[:3]), paths, strict=True):
            row, whole = x[3], [*path, *above[k]]
            value = x[2]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                value = leaf_of(row, row[1].translate({c: c + 32 for c in range(65, 91)}))
            for place, siblings in whole:
                value = h(*siblings[:place], value, *siblings[place:])
            out.append((row[0], x[2], subroot, root, h(*(d for _, sib in whole for d in sib)), value, value == root))
    return collections.Counter(out)


def found(df, **options):
    return collections.Counter(tuple(r) for r in merkle.manifest(df, **options).collect())


def random_rows(n, seed):
    draw = random.Random(seed)
    rows = [(i, f"Text {draw.randrange(40)} É", "en", draw.choice(["s0"] * 12 + ["s1", "s9", "é", "", None]), i % 7) for i in range(n)]
    rows += [(5, "Same Row", "de", "s0", 8)] * 40 + [(None, "No Id", None, "s0", 5)] * 30
    return [(*r, "clash", None, 1, 2) for r in rows]


@pytest.mark.parametrize("fanout, levels, n", [(16, 3, 700), (2, 2, 300), (3, 1, 90)])
def test_manifest_matches_a_recursion(spark, fanout, levels, n):
    rows = random_rows(n, fanout)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert found(df, fanout=fanout, levels=levels) == brute(rows, fanout)


def test_many_sources_make_a_tree_of_their_own(spark):
    rows = [(i, f"T{i}", None, f"s{i % 60:02}", i, "c", None, 1, 2) for i in range(150)]
    assert found(spark.createDataFrame(rows, DOCS), fanout=2, levels=2) == brute(rows, 2)


def test_odd_rows_empty_table_and_a_lone_row(spark):
    rows = odd_rows()
    assert found(spark.createDataFrame(rows, DOCS)) == brute(rows)
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []
    one = merkle.manifest(spark.createDataFrame(rows[:1], DOCS)).collect()[0]
    assert one.leaf == one.subroot == one.root == leaf_of(rows[0]) and one.proof_sha256 == h()


def test_tampering_is_noticed_where_it_changes_the_text(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "s", 5, None, None, 0, 0) for i in range(200)]
    wrong = {r.doc_id for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).where("not verified").collect()}
    assert wrong == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0} and wrong


def test_places_do_not_depend_on_partitions(spark):
    rows = random_rows(300, 3)
    places = [merkle.numbered(spark.createDataFrame(rows, DOCS).repartition(p).select(F.col("source").alias("tree"), "doc_id", "text"),
                              "tree", ["doc_id", "text"]).collect() for p in (1, 7)]
    assert sorted(map(str, places[0])) == sorted(map(str, places[1]))
    for tree, got in collections.Counter(r.tree for r in places[0]).items():
        assert sorted(r.place for r in places[0] if r.tree == tree) == list(range(got))
        assert {r.nodes for r in places[0] if r.tree == tree} == {got}
