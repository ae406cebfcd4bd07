"""The rewritten shards hold every row once, also rows without an id and rows that share one."""

import collections
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from affinis.llm import resharding
from tests.llm.test_operators import DOCS, odd_rows

FOLDER = "/root/testdata/sf0.001"


def test_every_row_is_written_once(spark, tmp_path):
    rows = odd_rows() + [(None, f"null {i}", "en", None, 6, None, None, i, 0) for i in range(40)]
    rows += [(77, "same id", "en", "s", i, None, None, i, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = resharding.reshard_files(docs, F.lit(0), shards=3, folder=f"{tmp_path}/shards", file_rows=20, bucket_rows=10).collect()
    names = [f for f in docs.columns]
    files = spark.read.parquet(f"{tmp_path}/shards")
    assert files.columns == [*names, "slot", "shard"]
    back = [tuple(r)[:len(names)] for r in files.collect()]
    assert collections.Counter(back) == collections.Counter(rows)
    assert sorted((r.doc_id or -1, r["size"]) for r in found) == sorted((r[0] or -1, len((r[1] or "").encode()) + 16) for r in rows)
    assert {(r.shard, r.slot) for r in files.collect()} == {(r.shard, r.slot) for r in found}
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_that_are_not_affected_are_not_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, "12345678") for i in range(40)], "doc_id long, text string")
    found = resharding.reshard_files(docs, F.pmod("doc_id", F.lit(4)), shards=4, folder=f"{tmp_path}/none").collect()
    assert len(found) == 40 and all(r.shard == r.old_shard == r.doc_id % 4 for r in found)
    assert resharding.reshard_files(docs.limit(0), F.lit(0), folder=f"{tmp_path}/empty").count() == 0


def test_ids_that_do_not_tell_rows_are_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, text string")
    with pytest.raises(ValueError):
        resharding.rewrite(docs, resharding.reshard(docs, F.lit(0), shards=2), f"{tmp_path}/shards")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_the_query_reads_the_written_shards(spark):
    df = entry.queries()["op5_resharding"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert any("/shard=" in f for f in df.inputFiles())
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    assert collections.Counter((r.doc_id, r.text_crc32) for r in df.collect()) == collections.Counter(
        (r[0], r[1]) for r in docs.select("doc_id", crc).collect())
