"""The index of test items: parts built in tasks, equal results for any number of parts, little memory on the driver."""

import random
import resource

import pytest
from pyspark.sql import functions as F

from affinis.llm import decontaminate
from tests.llm.test_operators import documents, items_of, prose


def planted(seed, n_items, n_texts):
    draw = random.Random(seed)
    items = [(k, prose(draw, draw.randint(6, 40), 3000), prose(draw, draw.randint(0, 5), 3000)) for k in range(n_items)]
    texts = [prose(draw, draw.randint(0, 100), 3000) for _ in range(n_texts)]
    for k in range(0, n_texts, 3):
        _, q, a = draw.choice(items)
        texts[k] = f"{texts[k]} {q} {a} {texts[k - 1]}"
    return items, texts


@pytest.mark.parametrize("held", [0, 1 << 30])
def test_results_do_not_depend_on_the_parts(spark, held, monkeypatch):
    items, texts = planted(1, 120, 45)
    docs = documents(spark, texts)
    whole = sorted(decontaminate.contaminated(docs, items_of(spark, items)).collect())
    assert len({r.doc_id for r in whole}) >= 15
    build = decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda items, limit=None: build(items, 3000))
    files = decontaminate.build_index(items_of(spark, items))
    assert files and spark.read.parquet(*files).count() > 3
    monkeypatch.setattr(decontaminate, "HELD_BYTES", held)
    assert sorted(decontaminate.contaminated(docs, items_of(spark, items)).collect()) == whole
    kept = decontaminate.drop_contaminated(docs, items_of(spark, items))
    assert {r.doc_id for r in kept.collect()} == set(range(45)) - {r.doc_id for r in whole}


def test_a_hundred_thousand_items(spark):
    word = "concat('w', pmod(xxhash64(id, k), 50000))"
    items = spark.range(100_000, numPartitions=8).select(
        F.col("id").alias("item_id"), F.expr(f"array_join(transform(sequence(1, 12), k -> {word}), ' ')").alias("question"),
        F.expr(f"array_join(transform(sequence(13, 14), k -> {word}), ' ')").alias("answer"))
    texts = items.where("item_id % 4000 = 17").select(
        F.col("item_id").alias("doc_id"), F.concat_ws(" ", F.lit("before it"), "question", "answer", F.lit("and after")).alias("text"))
    clean = spark.createDataFrame([(-1, "nothing of any test item is here"), (-2, None)], "doc_id long, text string")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = decontaminate.contaminated(texts.unionByName(clean), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, k) for k in range(17, 100_000, 4000)]
    # the driver's Python holds names of files, not items
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000
