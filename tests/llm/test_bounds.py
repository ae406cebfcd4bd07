"""Bounded memory of pieces, pages scanned once, hot and null ids, many labels, and text ids."""

import collections
import random
import re
import time
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinis.llm import language, mixing, ordinal, resharding, token_files, tokens
from tests.llm.test_operators import prose

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_are_remembered_up_to_a_number_of_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 100_000)
    own, draw = tokens.PieceEncoder(TOKENIZER), random.Random(1)
    library = Tokenizer.from_file(TOKENIZER)
    most = 0
    for batch in range(12):
        texts = [" ".join(f"{draw.random()} wort{draw.randrange(10 ** 6)} \u0441\u043b\u043e\u0432\u043e{draw.random()}" for _ in range(40)) for _ in range(5)]
        texts.append("x" * 5000 + str(batch))
        got = [len(x) // own.width for x in own.ids(texts)]
        assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
        most = max(most, own.held)
        assert not any(len(piece) > tokens.LONGEST for piece in own.known)
        assert own.held >= sum(len(piece) + len(ids) for piece, ids in own.known.items()) and not own.known.once
    assert most < 300_000  # the bound and a batch


HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.DOTALL | re.IGNORECASE)
LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.IGNORECASE)


def test_pages_read_as_by_the_pattern():
    draw = random.Random(2)
    parts = ["<script", "</script>", "</SCRIPT >", "<style>", "</style>", "<!--", "-->", "<p>", "</p>", "<", ">", " ", "text", "<html ", "lang=", "'de-AT'",
             "en", "<scripture>", "\n", "&amp;", "<html lang=fr>"]
    for _ in range(20_000):
        page = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        import html

        assert language.visible_text(page) == html.unescape(HIDDEN.sub(" ", page)), page
        found = LANG.search(page)
        assert language.declared_language(page) == (found[1] if found else None), page


def test_pages_take_linear_time():
    for unit in ("<script ", "<style>", "<!-- ", "<", "<html ", "<p ", "</script ", "<script></style>"):
        began = time.perf_counter()
        page = unit * (1_000_000 // len(unit))
        language.visible_text(page), language.declared_language(page)
        assert time.perf_counter() - began < 3


def test_labels_count_by_primary_subtag_and_are_bounded(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, prose(draw, 20), draw.choice(["en", "en-US", "EN", "de"])) for i in range(60)] + [(100 + i, "some text", f"x{chr(97 + i)}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {"en", "de"} <= set(language.train(docs).languages) and not {"en-us", "EN"} & set(language.train(docs).languages)
    monkeypatch.setattr(language, "MOST_LABELS", 2)
    assert language.train(docs).languages == ["de", "en"]


def test_grades_of_text_ids_are_sampled(spark):
    draw = random.Random(4)
    rows = [(f"d{i}", prose(draw, 30, 50), i % 3) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string")
    grades = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id string, grade int")
    model = ordinal.train(docs, grades, limit=100)
    assert len(model.thresholds) == 2 and model.weights.any()


def hot_rows(spark):
    """A third of the rows without an id, a third with one id, many wholly equal ones."""
    draw = random.Random(5)
    rows = [(None, prose(draw, draw.randint(0, 30)), "s0") for _ in range(300)] + [(7, prose(draw, draw.randint(0, 30)), "s0") for _ in range(300)]
    rows += [(7, "equal rows of seven words all alike", "s0")] * 400 + [(1000 + i, prose(draw, 12), f"s{i % 3}") for i in range(200)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def test_mix_and_shards_of_hot_ids(spark, tmp_path):
    rows, docs = hot_rows(spark)
    plan = mixing.plan_mix(docs, shard_docs=100).collect()
    assert len(plan) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in plan)
    assert sorted(map(str, plan)) == sorted(map(str, mixing.plan_mix(docs.repartition(9), shard_docs=100).collect()))
    mixed = collections.Counter(r.doc_id for r in mixing.mix(docs, shard_docs=100).collect())
    assert mixed[7] > 0 and mixed[None] > 0
    words = sum(len(r.text.split()) for r in mixing.mix(docs, shard_docs=100).collect())
    assert words == sum(r.taken for r in plan)
    found = resharding.reshard_files(docs, F.pmod(F.xxhash64("doc_id"), F.lit(5)), shards=8, folder=f"{tmp_path}/s", piece_rows=30).collect()
    assert collections.Counter((r.doc_id, r.text_crc32) for r in found) == collections.Counter((r[0], zlib.crc32(r[1].encode())) for r in rows)
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.1 * sum(sizes.values()) / 8


def test_token_files_of_hot_ids(spark, tmp_path):
    rows, docs = hot_rows(spark)
    library = Tokenizer.from_file(TOKENIZER)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    index = token_files.write_token_files(docs, TOKENIZER, f"{tmp_path}/t")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.select("part").distinct().count() > 1
    spread = index.where("doc_id = 7").groupBy("part").count().collect()
    assert len(spread) > 1  # one id is not one file
    found = token_files.read_documents(index, f"{tmp_path}/t").collect()
    expected = collections.Counter((r[0], len(library.encode(r[1], add_special_tokens=False).ids) + 1) for r in rows)
    assert collections.Counter((r.doc_id, r.n_tokens) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


@pytest.mark.parametrize("at_once", [3, 1000])
def test_copies_are_expanded_in_pieces(spark, at_once):
    from affinis.llm.common import expanded

    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 3)], "x string, n long")
    got = sorted((r.x, r.k) for r in expanded(df, "n", "k", at_once=at_once).collect())
    assert got == [("a", 0), *[("b", k) for k in range(7)], *[("c", k) for k in range(3)]]
