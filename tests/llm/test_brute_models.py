"""Scores of the two classifiers against plain Python, byte by byte."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from affinis.llm import language, ordinal
from affinis.llm import words as W
from tests.llm.test_operators import documents, graded, prose, spoken, words_of

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def word_hash(word, stem=None):
    return mix(sum(b * pow(BASE, i, 1 << 64) for i, b in enumerate(word.encode()[:stem])) & MASK)


def plain_features(text):
    """Numbers of the words, word beginnings, pairs of signs and traits of form of a text."""
    words, raw = words_of(text), text.encode()
    top = 64 - ordinal.FEATURE_BITS
    lexical = {word_hash(w) >> top for w in words}
    found = lexical | {mix((word_hash(w, ordinal.STEM) + ordinal.STEM) & MASK) >> top for w in words}

    def sign(b):
        return 33 <= b < 127 and not chr(b).isalnum()

    found |= {mix(((a << 8) | b) + (1 << 20)) >> top for a, b in zip(raw, raw[1:]) if sign(a) and sign(b)}
    total = max(len(raw), 1)
    shares = [sum(map(sign, raw)) / total, sum(65 <= b < 91 for b in raw) / total, sum(48 <= b < 58 for b in raw) / total,
              1 - len(lexical) / max(len(words), 1)]
    traits = [min(int(s * 40), 15) for s in shares] + [int(math.log2(total))]
    return found | {mix(value + 1000 * (k + 1)) >> top for k, value in enumerate(traits)}


def test_grades_are_those_of_plain_python(spark):
    rows = graded(random.Random(1), 300)
    docs = documents(spark, [t for _, t, _ in rows])
    model = ordinal.train(docs, spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int"))
    odd = [None, "", "...", "!!?? AB12 c", "Été à Łódź 日本語", "one", "x" * 3000] + [prose(random.Random(k), 40) for k in range(10)]
    scored = {r.doc_id: r for r in ordinal.score(documents(spark, odd), model).collect()}
    for k, text in enumerate(odd):
        s = sum(float(model.weights[f]) for f in plain_features(text or ""))
        tails = [1 / (1 + math.exp(t - s)) for t in model.thresholds.tolist()]
        assert scored[k].p_at_least == pytest.approx(tails, rel=1e-6)
        assert scored[k].expected_grade == pytest.approx(sum(tails), rel=1e-6)
        assert scored[k].selected == (tails[-1] >= 0.5)


def plain_grams(text):
    raw = (" " + " ".join(words_of(text)) + " ").encode() if words_of(text) else b" "
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        if not any(48 <= x <= 57 for x in (a, b, c)):
            yield (((a << 16 | b << 8 | c) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - language.GRAM_BITS)


def test_text_evidence_is_that_of_plain_python(spark):
    draw = random.Random(2)
    names = ["en", "de", "fr"]
    rows = [(i, spoken(draw, names[i % 3], draw.randint(3, 30)) + draw.choice(["", " 12a3", "  -- ", " É"]), names[i % 3]) for i in range(90)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == sorted(names)
    counts = {n: collections.Counter(g for _, t, own in rows if own == n for g in plain_grams(t)) for n in names}
    size = 1 << language.GRAM_BITS
    texts = [r[1] for r in rows[:20]] + ["", "...", "Über  den\tWolken", "a1b 22", "und und und"]
    scores, numbers = language.text_evidence(W.plain(pa.array(texts)), model)
    for text, own, n in zip(texts, scores, numbers, strict=True):
        grams = list(plain_grams(text))
        assert n == len(grams)
        share = min(1.0, language.EVIDENCE / max(n, 1))
        expected = [sum(math.log((counts[name][g] + language.SMOOTH) / (sum(counts[name].values()) + language.SMOOTH * size)) for g in grams)
                    * share for name in model.languages] + [-math.log(size) * len(grams) * share]
        assert own == pytest.approx(expected, rel=1e-4, abs=1e-4)
    assert np.isfinite(scores).all()
