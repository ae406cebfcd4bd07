"""Texts that share most of a passage crowd the buckets: classes stay right, and pairs don't grow with the square of their number."""

import itertools
import random

from affinis.llm import near_dedup
from affinis.operators.staging import materialize
from tests.llm.test_operators import bag, documents, prose, similarity


def crowded_texts(draw, n):
    passage = prose(draw, 100, 100_000)
    texts = [f"{passage} {prose(draw, 30, 1_000_000)}" for _ in range(n)]
    for k in range(0, n, 10):  # near copies among them
        own = texts[k].split()
        own[-3] = f"new{k}"
        texts.append(" ".join(own))
    return texts


def brute(texts, threshold=0.8):
    bags = [bag(t) for t in texts]
    return {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if similarity(bags[i], bags[j]) >= threshold}


def test_classes_among_texts_of_one_passage(spark):
    texts = crowded_texts(random.Random(3), 150)
    pairs = brute(texts)
    assert pairs
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in sorted(pairs):
        a, b = sorted((find(i), find(j)))
        parent[b] = a
    rows = near_dedup.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: find(i) for i in range(len(texts))}


def rare_pairs(spark, texts, labels=None):
    docs = documents(spark, texts)
    ids = docs.select("doc_id", near_dedup.fingerprint("text").alias("fp")).selectExpr("doc_id as id", "fp")
    elements = near_dedup._elements(ids, docs.select(near_dedup.fingerprint("text").alias("fp"), "text"))
    crowded = materialize(spark.createDataFrame([(i, labels[i] if labels else i) for i in range(len(texts))], "id long, label long"), "c")
    found = near_dedup._rare_pairs(crowded, elements, 0.8, block=7)
    return {(r.id_a, r.id_b) for r in found.collect()}


def test_rare_elements_lose_no_pair_and_stay_few(spark):
    draw = random.Random(4)
    texts = crowded_texts(draw, 100)
    base = prose(draw, 60, 50).split()
    for _ in range(40):  # repeated words, so shingles with counts
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(60)] = f"w{draw.randrange(50)}x"
        texts.append(" ".join(copy))
    texts = list(dict.fromkeys(texts))
    truth, found = brute(texts), rare_pairs(spark, texts)
    assert truth <= found and all(a < b for a, b in found)
    assert len(found) < 3 * len(truth) + 100  # of some 10,000 pairs
    labels = [i % 2 for i in range(len(texts))]
    assert {p for p in truth if labels[p[0]] != labels[p[1]]} <= rare_pairs(spark, texts, labels) <= {
        p for p in found if labels[p[0]] != labels[p[1]]}
