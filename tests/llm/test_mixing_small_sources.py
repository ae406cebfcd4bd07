"""A small source gives the same share of its words however large the table is."""

import collections

from affinis.llm import mixing

DOCS = "doc_id long, source string, text string"


def test_a_small_source_is_not_cut_up_by_a_large_one(spark):
    rows = [(i, "large", "w " * 40) for i in range(3000)] + [(5000 + i, "small", "one two three four five") for i in range(30)]
    rows += [(6000 + i, None, "a b c d e f g h i j k l") for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    taken, wanted = collections.Counter(), {}
    for r in mixing.plan_mix(docs, shard_docs=20).collect():
        taken[r.source] += r.taken
        wanted[r.source] = r.target
    assert wanted["small"] == 300 and wanted[None] == 480
    assert all(abs(taken[s] - wanted[s]) <= 2 * mixing.BLOCK for s in ("small", None))


def test_documents_without_words_make_no_shards(spark):
    rows = [(i, "s", "" if i % 50 else "one two three four five six seven eight") for i in range(3000)] + [(9000, "t", "w " * 2000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.plan_mix(docs, shard_docs=100).collect()
    assert len(found) == len(rows) and all(r.taken == 0 for r in found if not r["size"])
    target = next(r.target for r in found if r.source == "s")
    assert abs(sum(r.taken for r in found if r.source == "s") - target) <= 2 * mixing.BLOCK
