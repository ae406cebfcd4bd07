"""The pipeline's stages, one after the other, against plain Python; odd rows, clashing columns, and empty tables."""

import collections
import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from affinis.llm import mixing
from affinis.operators.staging import materialize
from tests.llm.test_operators import bag, similarity, spoken, targets, words_of

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, _fp string, _row long, _scores string, label string, "
           "band int, id long, _mix_row string, _mark string, slot int")
NAMES = ["en", "de", "fr"]


def corpus(draw):
    """Documents and what befalls them: the ids that language ID rejects, near copies, and test items."""
    texts = [(spoken(draw, NAMES[k % 3], draw.randint(12, 90)), NAMES[k % 3]) for k in range(120)]
    items = [(k, f"{spoken(draw, 'en', 25)}. {spoken(draw, 'en', 3)} end{k}.") for k in range(12)]
    base = texts[0][0].split()
    for k in range(15):  # near and exact copies
        copy = list(base)
        if k % 2 and len(base) > 40:
            copy[draw.randrange(len(copy))] = "thea"
        texts.append((" ".join(copy), "en"))
    leaks = set()
    for _, text in items[:5]:
        leaks.add(len(texts))
        texts.append((f"{spoken(draw, 'en', 20)} {text} {spoken(draw, 'en', 20)}", "en"))
    rejected = range(len(texts), len(texts) + 5)
    texts += [(None, "en"), ("", None), ("...", "en"), ("Это русский текст о погоде в городе и в лесу", None), ("1234 567", "de")]
    sources = ["hot"] * 5 + ["a", "b", None]
    rows = [(k, t, lang, draw.choice(sources), len(t or ""), "fp", k % 3, None, "x", 1, 7, "m", None, k) for k, (t, lang) in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[4][0] + " und", "de", "a", 5, None, None, None, None, None, None, None, None, None)]
    return rows, items, set(rejected), leaks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, items, *rest = corpus(random.Random(21))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items, *rest


def classes(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [bag(r.text) for r in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        if rows[i].text == rows[j].text or similarity(bags[i], bags[j]) >= 0.8:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    found = collections.defaultdict(list)
    for i, r in enumerate(rows):
        found[find(i)].append(r)
    return found.values()


def test_stages_match_plain_python(spark, folder):
    path, rows, items, rejected, leaks = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    after = {}
    for name, stage in stages.items():
        docs = materialize(stage(spark, docs, path), name)
        after[name] = docs.collect()
        if name != "token_output":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    told = collections.Counter(tuple(r) for r in rows)
    identified = collections.Counter(tuple(r) for r in after["language_id"])
    assert identified <= told and {r[0] for r in (told - identified)} == rejected

    kept = collections.Counter(tuple(r) for r in after["near_dedup"])
    least = [min(group, key=lambda r: (r.doc_id is None, r.doc_id)) for group in classes(after["language_id"])]
    assert sum(kept.values()) == len(least) and {r[0] for r in kept} == {r.doc_id for r in least} and kept <= identified

    def holds(text, item):
        question, answer = item.rsplit(". ", 1)
        shingles = {tuple(words_of(question)[i:i + 5]) for i in range(len(words_of(question)) - 4)}
        w = words_of(text)
        n = len(words_of(item))
        return any(len(shingles & {tuple(part[i:i + 5]) for i in range(len(part) - 4)}) >= 0.8 * len(shingles)
                   and len(set(words_of(answer)) & set(part)) >= 0.8 * len(set(words_of(answer)))
                   for part in (w[k:k + n] for k in range(max(1, len(w) - n + 1))))

    leaking = {r.doc_id for r in after["near_dedup"] if any(holds(r.text, item) for _, item in items)}
    assert leaking == leaks
    clean = collections.Counter(tuple(r) for r in after["decontamination"])
    assert kept - clean == collections.Counter({r: n for r, n in kept.items() if r[0] in leaking}) and clean <= kept

    sizes, taken, limit = collections.Counter(), collections.Counter(), {}
    for r in after["decontamination"]:
        sizes[r.source] += len(r.text.split())
        limit[r.doc_id] = r
    for r in after["mixing"]:
        taken[r.source] += len(r.text.split())
        own = limit[r.doc_id]
        assert r.n_chars == len(r.text) and not collections.Counter(r.text.split()) - collections.Counter(own.text.split())
    passes = collections.Counter(r.doc_id for r in after["mixing"])
    assert max(passes.values()) <= 2
    wanted = targets(sizes)
    assert all(abs(taken[s] - wanted[s]) <= 2 * mixing.BLOCK for s in sizes)

    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    expected = collections.Counter((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids) + 1) for r in after["mixing"])
    assert collections.Counter((r.doc_id, r.n_tokens) for r in after["token_output"]) == expected
    at = 0
    for r in sorted(after["token_output"], key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    whole = corpus_pipeline.run(spark, path).collect()
    assert sorted(map(str, whole)) == sorted(map(str, after["token_output"]))


def test_empty_tables(spark, folder, tmp_path):
    path, _, items, *_ = folder
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.decontamination(spark, docs, str(tmp_path)).count() == docs.count()
