"""Each operator against a brute-force version or exact round trip, and on nulls, empty and long texts, ties, repeats, clashes."""

import collections
import itertools
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinis.llm import decontaminate, language, mixing, near_dedup, ordinal, pii, resharding, search, token_files, tokens
from affinis.llm import words as W
from affinis.llm.common import components, merged_components

DOCS = "doc_id long, text string, lang string, source string, n_chars int, fp string, label string, id long, band long"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def words_of(text):
    return regex.findall(r"[\p{L}\p{N}\p{M}]+", (text or "").lower())


def prose(draw, n, vocabulary=400):
    return " ".join(f"w{int(draw.paretovariate(0.7)) % vocabulary}x" for _ in range(n))


def odd_rows():
    """Null, empty, wordless, very long and repeated rows, null ids, equal ids, clashing column names."""
    long = " ".join(f"long{i % 977}" for i in range(30_000))
    texts = [None, "", "...", "one", "a b c", long, long, "Été à Łódź", "日本語 テキスト", "x" * 50_000, "tab\tand\n\nline  end "]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "s0", 3), (3, "one", "en", "s0", 3), (None, "no id here", None, None, 10), (5, "other text", "en", "s1", 0)]
    return [(*r, "clash", None, 1, 2) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else f"s{i % 5}", len(t or ""), None, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# --- words

def test_words_are_runs_of_letters_digits_and_marks_in_any_batch():
    texts = ["a b c", "Hello, world! été Œuvre", "", "!!!", "Ünï “quoted” text’s 日本 語", "a×b÷c", "x y z w v u x y z w v u"]
    together, starts = W.word_hashes(W.plain(pa.array([*texts, None])))
    for k, text in enumerate(texts):
        alone, _ = W.word_hashes(W.plain(pa.array([text])))
        assert len(alone) == len(words_of(text)) and (alone == together[starts[k]:starts[k + 1]]).all()
    shingles, owner = W.shingles(together, starts)
    assert collections.Counter(owner.tolist()) == {k: max(1, len(words_of(t)) - 4) for k, t in enumerate(texts) if words_of(t)}


# --- 1 token counts

def test_token_counts_are_those_of_the_library(spark, odd, empty):
    draw = random.Random(1)
    parts = ["a", "Z", "é", "ж", "日", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "’", "\xa0", "1", "23", "٣", ",", "#",
             "<|endoftext|>", "　", "\r\n", "\x1c", "\x85", "ß", "don't"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(20_000)]
    own, library = tokens.PieceEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == expected
    rows = tokens.token_counts(odd, TOKENIZER).collect()
    counts = collections.Counter(
        (r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 512) for r in odd_rows())
    assert collections.Counter(tuple(r) for r in rows) == counts
    assert tokens.token_counts(empty, TOKENIZER).count() == 0


# --- 2 decontamination

def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, question string, answer string")


def test_decontamination_finds_what_brute_force_finds(spark):
    draw = random.Random(2)
    items = [(k, prose(draw, draw.randint(6, 60)), prose(draw, draw.randint(0, 6))) for k in range(25)]
    texts = []
    for k in range(60):
        text = prose(draw, draw.randint(0, 150)).split()
        if k % 3 == 0:
            _, q, a = draw.choice(items)
            part = q.split() + a.split()
            for _ in range(k % 7):
                part[draw.randrange(len(part))] = "changed"
            place = draw.randint(0, len(text))
            text[place:place] = part
        texts.append(" ".join(text))

    def shingles(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    expected = set()
    for d, text in enumerate(texts):
        w = words_of(text)
        for k, q, a in items:
            n = len(words_of(q)) + len(words_of(a))
            for begin in range(0, max(1, len(w) - n // 2)):
                part = w[begin:begin + n]
                if (len(shingles(words_of(q)) & shingles(part)) >= 0.8 * len(shingles(words_of(q)))
                        and len(set(words_of(a)) & set(part)) >= 0.8 * len(set(words_of(a)))):
                    expected.add((d, k))
                    break
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, texts), items_of(spark, items)).collect()}
    assert expected and expected <= found  # a passage is twice as long as an item, so it may hold more than a tight window
    clean = decontaminate.drop_contaminated(documents(spark, texts), items_of(spark, items))
    assert {r.doc_id for r in clean.collect()} == set(range(60)) - {d for d, _ in found}


def test_pruning_retrieves_every_item_above_the_threshold(spark):
    draw = random.Random(3)
    rows = [type("R", (), {"item_id": k, "question": prose(draw, 30, 90), "answer": ""}) for k in range(50)]
    df = collections.Counter(t for r in rows for t in set(W.word_hashes(W.plain(pa.array([r.question])))[0].view(np.int64).tolist()))
    classes = decontaminate._classes(rows, df, 50, 30.0)
    text = prose(draw, 300, 90)
    found = {(h[0], h[1]) for h in decontaminate._search(W.plain(pa.array([text])), classes, 0.4, 0.0)}
    expected = set()
    for own in classes:
        w = W.word_hashes(W.plain(pa.array([text])))[0]
        for begin in range(0, len(w), own.longest):
            part = set(w[begin:begin + 2 * own.longest].tolist())
            scores = own.impacts.reshape(len(own.terms), -1)[[t in part for t in own.terms.tolist()]].sum(axis=0)
            expected |= {(0, int(own.items[k])) for k in np.flatnonzero(scores[:len(own.items)] >= 0.4)}
    assert expected and found == expected


def test_decontamination_of_odd_rows(spark, odd, empty):
    items = items_of(spark, [(1, "long0 long1 long2 long3 long4 long5", "long6"), (None, "one", "two"), (2, None, None), (3, "...", "")])
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()} == {(5, 1), (6, 1)}
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows()) - 2
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == len(odd_rows())


# --- 3 mixing

def test_seats_go_to_the_highest_quotients():
    draw = random.Random(4)
    for _ in range(300):
        n = draw.randint(1, 8)
        votes, most = [draw.randint(0, 30) for _ in range(n)], [draw.randint(0, 20) for _ in range(n)]
        seats, expected = draw.randint(0, 60), [0] * n
        ranked = sorted((-votes[i] / (2 * k + 1), i) for i in range(n) if votes[i] for k in range(most[i]))
        for _, i in ranked[:seats]:
            expected[i] += 1
        assert mixing.sainte_lague(np.array(votes, float), np.array(most), seats).tolist() == expected


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        rate = left / sum(weights[s] for s in free)
        over = {s for s in free if rate * weights[s] > 2 * sizes[s]}
        if not over:
            return out | {s: rate * weights[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("shard_docs", [40, 8192])
def test_mix_meets_the_targets(spark, shard_docs):
    draw = random.Random(5)
    sources = [draw.choice(["a", "b", "é", "Z", None, "hot", "hot", "hot"]) for _ in range(400)]
    texts = [prose(draw, draw.randint(0, 120)) for _ in sources]
    docs = documents(spark, texts, sources)
    rows = mixing.plan_mix(docs, shard_docs=shard_docs, block=8).collect()
    assert sorted((r.doc_id, r["size"]) for r in rows) == [(i, len(t.split())) for i, t in enumerate(texts)]
    sizes = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    wanted = targets(sizes)
    shards = -(-400 // shard_docs)
    for r in rows:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - wanted[s]) <= 16 * (shards + 2) for s in sizes)
    again = mixing.plan_mix(docs.repartition(7), shard_docs=shard_docs, block=8).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}
    mixed = collections.Counter()
    for r in mixing.mix(docs, shard_docs=shard_docs, block=8).collect():
        mixed[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(texts[r.doc_id].split())
    assert mixed == collections.Counter({r.doc_id: r.taken for r in rows if r.taken})


def test_mix_of_odd_rows(odd, empty):
    rows = mixing.plan_mix(odd).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted(
        (r[0] or -1, len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in odd_rows())
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


# --- 4 quality classifier

def graded(draw, n):
    rows = []
    for i in range(n):
        grade = draw.choice([0, 1, 2])
        text = prose(draw, draw.randint(30, 150))
        rows.append((i, text + " foul" * (grade == 0) + " ||| %%%" * (grade < 2), grade))
    return rows


def test_ordinal_model_grades_held_out_rows(spark):
    rows = graded(random.Random(6), 900)
    docs = documents(spark, [t for _, t, _ in rows])
    grades = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int")
    model = ordinal.train(docs, grades.where("doc_id < 600"))
    assert (np.diff(model.thresholds) > 0).all()
    scored = ordinal.score(docs, model).where("doc_id >= 600").collect()
    truth = {i: g for i, _, g in rows}
    assert np.mean([round(r.expected_grade) == truth[r.doc_id] for r in scored]) > 0.95
    assert all(r.p_at_least[0] >= r.p_at_least[1] and r.expected_grade == pytest.approx(sum(r.p_at_least)) for r in scored)
    again = ordinal.train(docs.repartition(5), grades.where("doc_id < 600").repartition(2))
    assert (again.weights == model.weights).all()


def test_gradient_of_the_ordinal_model_lowers_the_loss():
    draw = np.random.default_rng(7)
    columns = draw.integers(0, 50, 4000)
    starts, grades = np.arange(0, 4001, 10), (np.bincount(np.repeat(np.arange(400), 10), weights=columns < 20) // 3).astype(int).clip(0, 2)
    model = ordinal.fit_ordinal(columns, starts, grades)
    tails = model.tails(ordinal._sums(model.weights[columns], starts))
    assert np.mean((tails >= 0.5).sum(axis=1) == grades) > 0.85


def test_classifier_of_odd_rows(spark, odd, empty):
    grades = spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (5, 1), (5, 2)], "doc_id long, grade int")
    model = ordinal.train(odd, grades)
    assert ordinal.score(odd, model).count() == len(odd_rows())
    assert ordinal.score(empty, model).count() == 0
    assert np.isfinite(ordinal.train(empty, grades.limit(0)).thresholds).all()


# --- 5 resharding

def test_flow_has_least_cost():
    draw = random.Random(8)
    for _ in range(100):
        supplies, demands = [draw.randint(0, 5) for _ in range(3)], [0] * 4
        for _ in range(sum(supplies)):
            demands[draw.randrange(4)] += 1
        prices = {(i, j): draw.randint(0, 4) for i in range(3) for j in range(4)}
        flow, cost = resharding.min_cost_flow(supplies, demands, lambda i, j: prices[i, j])
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(3)] == supplies
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(4)] == demands
        states = {tuple(demands): 0}
        for i, amount in enumerate(supplies):
            for _ in range(amount):
                after = {}
                for left, paid in states.items():
                    for j in range(4):
                        if left[j]:
                            key = (*left[:j], left[j] - 1, *left[j + 1:])
                            after[key] = min(after.get(key, math.inf), paid + prices[i, j])
                states = after
        assert cost == sum(v * prices[k] for k, v in flow.items()) == min(states.values())


def test_resharding_balances_bytes_and_moves_the_least(spark, tmp_path):
    draw = random.Random(9)
    texts = [prose(draw, draw.randint(0, 60)) for _ in range(3000)]
    docs = documents(spark, texts)
    old = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(6)))
    placed = resharding.reshard(docs, old, shards=8, bucket_rows=100)
    rows = placed.collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == [
        (i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in enumerate(texts)]
    sizes, before, moved = collections.Counter(), collections.Counter(), 0
    for r in rows:
        sizes[r.shard] += r["size"]
        before[r.old_shard] += r["size"]
        moved += r["size"] * (r.shard != r.old_shard)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) < 0.03 * mean for s in sizes.values())
    assert moved <= sum(max(0, s - mean) for s in before.values()) + 0.03 * mean * 8
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    written = resharding.rewrite(docs, placed, f"{tmp_path}/shards", file_rows=100)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert {(r.doc_id, r.shard, r.text) for r in back.collect()} == {
        (r.doc_id, r.shard, texts[r.doc_id]) for r in rows if r.shard in written}


def test_resharding_of_odd_rows(odd, empty):
    rows = resharding.reshard(odd, F.lit(0), shards=3).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((r[0] or -1, len((r[1] or "").encode()) + 16) for r in odd_rows())
    assert resharding.reshard(empty, F.lit(0)).count() == 0


# --- 6 near duplicates

def bag(text):
    w = words_of(text)
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def similarity(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common) if common else 0.0


def test_signatures_estimate_weighted_similarity_without_bias():
    draw = random.Random(10)
    one = " ".join(f"w{i}" for i in range(100)) + " " + "z " * 40
    two = " ".join(f"w{i}" for i in range(20, 120)) + " " + "z " * 70
    three = prose(draw, 60, 5)
    for x, y in ((one, two), (three, three + " " + prose(draw, 30, 5))):
        texts = W.plain(pa.array([x, y]))
        agree = [(s[0] == s[1]).mean() for s in (near_dedup.signatures(texts, 256, seed)[0] for seed in range(40))]
        truth = similarity(bag(x), bag(y))
        assert abs(np.mean(agree) - truth) < 4 * math.sqrt(truth * (1 - truth) / (40 * 256))


def near_copies(draw):
    """Groups of near and exact copies, one large, a chain, and texts that share a passage only."""
    texts = [prose(draw, draw.randint(1, 120), 100_000) for _ in range(60)]
    base = prose(draw, 150, 100_000).split()
    for _ in range(120):
        copy = list(base)
        for _ in range(draw.randint(0, 5)):
            copy[draw.randrange(150)] = f"new{draw.random()}"
        texts.append(" ".join(copy))
    chain = prose(draw, 100, 100_000).split()
    for k in range(8):
        chain[12 * k] = f"link{k}"
        texts.append(" ".join(chain))
    passage = prose(draw, 50, 100_000)
    texts += [f"{prose(draw, 60, 100_000)} {passage}" for _ in range(60)]
    return texts + ["same text here now ok"] * 30 + ["a b", "a b", "A, b!"]


def test_classes_are_those_of_brute_force(spark):
    texts = near_copies(random.Random(11))
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if similarity(bags[i], bags[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    expected = {i: find(i) for i in range(len(texts))}
    rows = near_dedup.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == expected
    sizes = collections.Counter(expected.values())
    assert all(r.class_rows == sizes[r.class_id] for r in rows)
    kept = near_dedup.drop_near_duplicates(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_components_are_merged(spark):
    draw = random.Random(17)
    first, second = ([(draw.randrange(n), draw.randrange(n)) for _ in range(15)] for n in (40, 50))
    least = {v: v for v in range(50)}
    for _ in range(50):
        for a, b in first + second:
            least[a] = least[b] = min(least[a], least[b])
    df = [spark.createDataFrame(e, "a long, b long") for e in (first, second)]
    labels = merged_components(components(df[0]), df[1])
    found = {r.node: r.label for r in labels.collect()}
    assert {v: found.get(v, v) for v in least} == least


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.class_id, r.class_rows) for r in near_dedup.near_duplicates(odd).collect()]
    assert collections.Counter(rows) == collections.Counter(
        [(0, 0, 2), (1, 0, 2), (2, 2, 1), (3, 3, 3), (3, 3, 3), (3, 3, 3), (4, 4, 1), (5, 5, 2), (6, 5, 2), (7, 7, 1), (8, 8, 1),
         (9, 9, 1), (10, 10, 1), (None, None, 1), (5, 5, 1)])
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 2, 3, 4, 5, 5, 7, 8, 9, 10]
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_duplicates(empty).count() == 0


# --- 7 token files

def test_token_files_give_back_every_document(spark, odd, empty, tmp_path):
    draw = random.Random(12)
    texts = [prose(draw, draw.randint(0, 200)) for _ in range(400)]
    docs, library = documents(spark, texts), Tokenizer.from_file(TOKENIZER)
    folder = f"{tmp_path}/tokens"
    index = token_files.write_token_files(docs, TOKENIZER, folder, length=64)
    ids = [[*e.ids, 2] for e in library.encode_batch(texts, add_special_tokens=False)]
    starts = np.cumsum([0, *map(len, ids)])
    rows = {tuple(r) for r in token_files.read_documents(index, folder).collect()}
    assert rows == {(i, int(starts[i]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)}
    for name in {r.file for r in index.select("file").collect()}:
        file = token_files.TokenFile(folder, name)
        batch = file.sequences(0)
        assert batch.column("ids").type == pa.list_(pa.uint16(), 64) and batch.column("mask").type == pa.list_(pa.bool_(), 64)
        total = sum(r.n_tokens for r in index.where(F.col("file") == name).collect())
        masks = [file.sequences(k).column("mask").flatten().to_numpy(zero_copy_only=False) for k in range(file.reader.num_record_batches)]
        assert np.concatenate(masks).sum() == total
        whole = pa.ipc.open_file(file.source).read_all().column("ids").combine_chunks().flatten().to_numpy()
        first = index.where(F.col("file") == name).orderBy("first").first()
        assert whole[:first.n_tokens].tolist() == ids[first.doc_id]
    rows = token_files.tokens_by_document(odd, TOKENIZER, f"{tmp_path}/odd").collect()
    by_text = collections.Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in odd_rows())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in rows) == by_text
    assert token_files.tokens_by_document(empty, TOKENIZER, f"{tmp_path}/empty").count() == 0


# --- 8 language

SPOKEN = {"en": "the and of with this that from were", "de": "der die das und mit für nicht über", "fr": "le la et des pour où être été"}


def spoken(draw, name, n):
    return " ".join(draw.choice(SPOKEN[name].split()) + draw.choice("abc") for _ in range(n))


def test_language_of_held_out_texts_and_of_other_scripts(spark):
    draw = random.Random(13)
    rows = [(i, spoken(draw, name := draw.choice(list(SPOKEN)), draw.randint(3, 60)), name) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df.where("doc_id < 400"))
    texts = [t for _, t, _ in rows]
    scores, _ = language.text_evidence(W.plain(pa.array(texts)), model)
    assert np.mean([model.languages[k] == rows[i][2] for i, k in enumerate(scores[400:, :-1].argmax(axis=1), 400)]) > 0.97
    alone = [language.text_evidence(W.plain(pa.array([t])), model)[0][0] for t in texts[:50]]
    assert np.allclose(alone, scores[:50])  # whatever else is in the batch
    other = spark.createDataFrame([("Это русский текст о погоде", None, None)], "text string, declared string, host string")
    assert [(r.language, r.accepted) for r in language.identify(other, model).collect()] == [("und", False)]


def test_fusion_is_the_product_of_the_evidence(spark):
    """Against the formula, with leave-one-out counts, on few records."""
    draw = random.Random(14)
    hosts = ["a.x.de", "b.x.de", "y.com", None]
    rows = [(i, spoken(draw, draw.choice(list(SPOKEN)), draw.randint(1, 3)), draw.choice(["en", "de-AT", "fr", None]), draw.choice(hosts))
            for i in range(60)] + [(60, "", "en", "y.com")]
    model = language.train(spark.createDataFrame([(i, spoken(draw, n, 40), n) for i, n in enumerate(list(SPOKEN) * 20)],
                                                 "doc_id long, text string, lang string"))
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string")
    found = {r.doc_id: r for r in language.identify(df, model).collect()}
    scores, n = language.text_evidence(W.plain(pa.array([r[1] for r in rows])), model)
    best = [int(s.argmax()) if m else None for s, m in zip(scores, n, strict=True)]
    ranks = len(model.languages) + 1
    keys = {"declared": lambda r: (r[2] or "").split("-")[0] or None, "suffix": lambda r: r[3] and r[3].split(".")[-1],
            "domain": lambda r: r[3] and ".".join(r[3].split(".")[-2:]), "host": lambda r: r[3]}
    counts = {k: collections.Counter((f(r), b) for r, b in zip(rows, best, strict=True) if b is not None and f(r)) for k, f in keys.items()}
    total = collections.Counter(b for b in best if b is not None)
    for r, s, b in zip(rows, scores, best, strict=True):
        if b is None:
            assert (found[r[0]].language, found[r[0]].probability, found[r[0]].accepted) == ("und", 0.0, False)
            continue
        logs = []
        for k in range(ranks):
            p = (total[k] + 1) / (sum(total.values()) + ranks)
            for level in ("domain", "host"):
                if key := keys[level](r):
                    of = {j: counts[level][key, j] - (j == b) for j in range(ranks)}
                    p = (of[k] + 10 * p) / (sum(of.values()) + 10)
            log = s[k] + math.log(p)
            for name in ("declared", "suffix"):
                if key := keys[name](r):
                    kinds = len({x for x, _ in counts[name]})
                    log += math.log((counts[name][key, k] - (k == b) + 1) / (total[k] + kinds + 1))
            logs.append(log)
        p = np.exp(np.array(logs) - max(logs))
        assert found[r[0]].probability == pytest.approx((p / p.sum()).max())
        assert found[r[0]].language == [*model.languages, "und"][int(p.argmax())]


def test_language_of_odd_rows_and_pages(spark, odd, empty):
    model = language.train(spark.createDataFrame([(i, f"{SPOKEN[n]} one other text no id here", n) for i, n in enumerate(SPOKEN)],
                                                 "doc_id long, text string, lang string"))
    kept = language.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({0, 1, 2})
    assert language.keep_identified(empty, model).count() == 0
    assert language.train(empty).languages == []
    pages = spark.createDataFrame([(1, "http://U@Sub.Example.de:80/x", "<HTML Lang='de-AT'><script>a</script><p>Über &amp; mehr</p>"),
                                   (2, None, None)], "page_id long, url string, html string")
    rows = {r.page_id: (r.text.split(), r.declared, r.host) for r in language.page_records(pages).collect()}
    assert rows == {1: (["Über", "&", "mehr"], "de-AT", "sub.example.de"), 2: ([], None, None)}


# --- 9 search

def best_documents(texts, ids, queries, k):
    bags = [collections.Counter(words_of(t)) for t in texts]
    lengths = [sum(b.values()) for b in bags]
    n, mean = len(bags), sum(lengths) / len(bags)
    df = collections.Counter(w for b in bags for w in b)
    out = []
    for query in queries:
        scores = collections.defaultdict(float)
        for w in set(words_of(texts[query])):
            idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            for d, b in enumerate(bags):
                if w in b:
                    scores[d] += idf * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * lengths[d] / mean))
        ranked = sorted((-round(s, 6), ids[d] is None, ids[d] or 0) for d, s in scores.items())[:k]
        out += [(ids[query], r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("shard_docs", [30, 10_000])
def test_search_is_exact(spark, shard_docs):
    draw = random.Random(15)
    texts = [prose(draw, draw.randint(0, 80), draw.choice([50, 3000])) for _ in range(200)] + ["", None, "..."]
    texts += [texts[0]] * 25 + [texts[20]] * 3
    ids = [*range(len(texts) - 1), None]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    rows = search.search(docs, queries, 10, shard_docs=shard_docs).collect()
    expected = best_documents(texts, ids, [i for i in ids if i is not None and i % 20 == 0], 10)
    found = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in rows)
    expected = sorted(expected)
    assert [x[:3] for x in found] == [x[:3] for x in expected]
    assert [x[3] for x in found] == pytest.approx([x[3] for x in expected], abs=1e-4)


def test_search_of_odd_rows(spark, odd, empty):
    queries = odd.select(F.lit(7).alias("query_id"), F.lit("one a").alias("text")).limit(1)
    assert {r.doc_id for r in search.search(odd, queries).collect()} == {3, 4}
    assert search.search(empty, queries).count() == 0 and search.search(odd, queries.limit(0)).count() == 0


# --- 10 personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": all(int(x) <= 255 for x in text.split(".")) if kind == "ip" else True,
            "card": 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else True, "phone": 9 <= len(digits) <= 15}[kind]


def test_plain_spans_are_those_of_the_patterns():
    draw = random.Random(16)
    parts = [*"a.@-+%_ 1.2.25.9()", "@", "4111 1111 1111 1111", "+1 (555) 123-4567", "1.2.3.4", "x@y.z", "..", "@@", "300", "é", "\n"]
    for _ in range(30_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        expected = [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PATTERNS[k], text) if valid(k, m[0])]
        assert pii.plain_spans(text) == expected
        plain, every = pii.find_spans(text)
        assert plain == expected and set(expected) <= set(every)


@pytest.mark.parametrize("text, kind, source", [
    ("write john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("mail john.doe [at] example [dot] com!", "email", "john.doe [at] example [dot] com"),
    ("x john(at)example.com x", "email", "john(at)example.com"),
    ("x jоhn@ехample.com x", "email", "jоhn@ехample.com"),
    ("x ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ x", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("x jo​hn@exa​mple.com x", "email", "jo​hn@exa​mple.com"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("card four one one one 1111 1111 one one one one end", "card", "four one one one 1111 1111 one one one one"),
    ("at 192 dot 168 dot 1 dot 1 now", "ip", "192 dot 168 dot 1 dot 1"),
    ("at one nine two dot one six eight dot zero dot one now", "ip", "one nine two dot one six eight dot zero dot one"),
])
def test_disguised_spans_map_back_to_the_source(text, kind, source):
    plain, every = pii.find_spans(text)
    assert plain == [] and [(k, text[a:b]) for k, a, b in every] == [(kind, source)]


@pytest.mark.parametrize("text", ["we met at home. I saw", "look at example.com", "five six people at noon", "at dot dot at", ""])
def test_clean_text_is_left_alone(text):
    assert pii.find_spans(text) == ([], [])


def test_personal_data_of_odd_rows_and_long_runs(spark, odd, empty):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(odd_rows()) and all(r.spans == "" and r.n_email == r.n_ip == r.n_card == r.n_phone == 0 for r in rows)
    assert pii.personal_data(empty).count() == 0
    for text in ("a" * 100_000, "1" * 100_000, "1." * 50_000, "a@" * 50_000, "one " * 30_000, "x at y dot z " * 8_000, "a.b." * 20_000 + " dot "):
        pii.find_spans(text)  # in time that grows with the length


# --- registration

def test_queries_are_registered_and_leave_the_rest_alone():
    import __spark_entry__ as entry
    import corpus_pipeline

    names = {re.match(r"op(\d+)_", n)[1] for n in entry.queries() if n.startswith("op")}
    assert names == {str(n) for n in range(1, 14)} and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    assert json.dumps(sorted(entry.oracle_sql()))
