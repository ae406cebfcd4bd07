"""The bounded sample of the language model holds rows of every label."""

import random

from pyspark.sql import functions as F

from affinis.llm import language


def test_a_rare_language_is_learned_from_all_its_rows(spark):
    draw = random.Random(31)
    rows = [(i, " ".join(draw.choice(["the", "and", "house", "green"]) for _ in range(8)), "en") for i in range(4000)]
    rows += [(10_000 + i, " ".join(draw.choice(["zwölf", "über", "straße", "fünf"]) for _ in range(8)), "DE") for i in range(6)]
    rows += [(None, f"il faut que {i}", "fr") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, limit=200)
    assert model.languages == ["de", "en", "fr"]
    whole = language.train(docs.where("lang = 'DE'"), limit=10_000)
    assert (model.table[:, 0] == whole.table[:, 0]).all()
    twice = language.train(docs.withColumn("doc_id", F.lit(None).cast("long")), limit=200)
    assert twice.languages == model.languages


def test_the_sample_stays_bounded():
    assert language.label_bound([10, 20], 100) == float("inf")
    assert language.label_bound([], 100) == float("inf")
    for counts in ([10, 5000, 400], [1000] * 4, [3, 3, 10 ** 9]):
        bound = language.label_bound(counts, 600)
        assert abs(sum(min(n, bound) for n in counts) - 600) < 1e-6
    assert language.label_bound([10 ** 6] * 1000, 4000) == language.LABEL_ROWS
