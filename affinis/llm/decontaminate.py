"""Benchmark decontamination: every passage of the training texts queries a BM25 index of the test items.

The index holds, for every term, its postings: the items it occurs in and its BM25 impact there, divided by the score that the item gives its
own words, so 1.0 means "all of the item's words". Items are dealt into length classes, and within a class into blocks; the index
keeps the highest impact of each term in each block and overall. Texts are cut into passages of twice the longest item of the
class, one overlapping half of the next, so any run as long as an item lies whole in one passage.

A passage is a query of all its distinct words. Block-max WAND pruning: words that no item has are dropped; a passage whose highest
impacts add up to less than the threshold is passed over; for the rest, so is every block of items whose own highest impacts add up to
less; only in the blocks that are left, items are scored exactly. All items at or above the threshold are retrieved and verified: of the
question's distinct five-word shingles, the passage must hold at least ``overlap``, and the same share of the answer's words.

Items are dealt into parts of a bounded number of bytes. Each part's postings are made in a task, under the statistics of all items, and stored in
the shared folder; the driver knows the names of the files. The texts are scanned once: a task holds each batch against one part after the
other, and keeps parts in memory up to a bound.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm import words as W
from affinis.llm.common import text_of
from affinis.llm.token_files import _place
from affinis.operators.staging import materialize

K1, B = 1.2, 0.75
SCORE = 0.5
OVERLAP = 0.8
ITEMS_PER_BLOCK = 16
INDEX_BYTES = 2 << 20
HELD_BYTES = 64 << 20
#: bounds of passages and blocks that are held at a time
CELLS = 500_000
_U = np.uint64
_BITS = 20


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all the given ranges, one after the other."""
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(int(lengths.sum()))


@dataclass
class LengthClass:
    """The index of the items of one length class: postings ``(term, slot, impact)``, sorted, and an entry for each term and block."""

    longest: int
    items: list
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray
    slots: np.ndarray
    weights: np.ndarray
    lists: np.ndarray

    def __post_init__(self):
        of_term = np.repeat(np.arange(len(self.terms)), np.diff(self.lists))
        block = self.slots // ITEMS_PER_BLOCK
        first = np.flatnonzero((np.diff(of_term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.starts = np.append(first, len(self.slots))
        self.block, self.blocks = block[first], -(-len(self.items) // ITEMS_PER_BLOCK)
        self.highest = np.maximum.reduceat(self.weights, first)
        self.entries = np.searchsorted(of_term[first], np.arange(len(self.terms) + 1))
        self.term_max = np.maximum.reduceat(self.weights, self.lists[:-1])
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.terms >> _U(64 - _BITS)] = True

    @property
    def size(self) -> int:
        """Bytes, about."""
        arrays = (self.terms, self.slots, self.weights, self.lists, self.starts, self.block, self.highest, self.entries, self.known)
        return sum(a.nbytes for a in (*arrays, *self.questions, *self.answers)) + 300 * len(self.items)

    @property
    def impacts(self) -> np.ndarray:
        """The postings as a matrix of terms and items, for a look at small classes."""
        out = np.zeros((len(self.terms), len(self.items)), np.float32)
        out[np.repeat(np.arange(len(self.terms)), np.diff(self.lists)), self.slots] = self.weights
        return out

    def candidates(self, terms: np.ndarray, score: float) -> list[tuple[int, float]]:
        """Items that reach the score with the given distinct terms, and their scores; blocks that can't are passed over."""
        entry = _ranges(self.entries[terms], self.entries[terms + 1])
        bounds = np.bincount(self.block[entry], weights=self.highest[entry], minlength=self.blocks)
        chosen = entry[bounds[self.block[entry]] >= score * (1 - 1e-5)]
        if not len(chosen):
            return []
        places = _ranges(self.starts[chosen], self.starts[chosen + 1])
        scores = np.bincount(self.slots[places], weights=self.weights[places])
        return [(slot, float(scores[slot])) for slot in np.flatnonzero(scores >= score * (1 - 1e-6)).tolist()]

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that the index has, and their term numbers."""
        place = np.flatnonzero(self.known[words >> _U(64 - _BITS)])
        term = np.searchsorted(self.terms, words[place])
        term[term == len(self.terms)] = 0
        found = self.terms[term] == words[place]
        return place[found], term[found]


def term_statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """``(term, df)`` over all items, their number, and their mean length in words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                words, starts = W.word_hashes(texts.slice(i, j - i))
                text = np.repeat(np.arange(j - i), np.diff(starts))
                order = np.lexsort((words, text))
                first = (np.diff(text[order], prepend=-1) != 0) | (np.diff(words[order], prepend=words[order][:1] ^ _U(1)) != 0)
                terms, df = np.unique(words[order][first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(df.astype(np.int64)),
                                                  pa.nulls(len(terms), pa.int64()), pa.nulls(len(terms), pa.int64())],
                                                 names=["term", "df", "items", "words"])
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                                  pa.array([int((np.diff(starts) > 0).sum())]), pa.array([len(words)])],
                                                 names=["term", "df", "items", "words"])

    counts = materialize(items.select(F.concat_ws("\n", "question", "answer").alias("text")).mapInArrow(
        count, "term long, df long, items long, words long"), "item-terms")
    total = counts.agg(F.sum("items"), F.sum("words")).first()
    n, words = total[0] or 0, total[1] or 0
    return counts.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")), n, words / n if n else 0.0


def _classes(rows: list, df: dict[int, int], n: int, mean: float) -> list[LengthClass]:
    """Index of the given items under the statistics of all."""
    out: dict[int, list] = {}
    texts = W.plain(pa.array([f"{r.question}\n{r.answer}" for r in rows]))
    words, starts = W.word_hashes(texts)
    question, q_starts = W.word_hashes(W.plain(pa.array([r.question for r in rows], pa.string())))
    answer, a_starts = W.word_hashes(W.plain(pa.array([r.answer for r in rows], pa.string())))
    for k in range(len(rows)):
        own = words[starts[k]: starts[k + 1]]
        if not len(own):
            continue
        q, a = question[q_starts[k]: q_starts[k + 1]], answer[a_starts[k]: a_starts[k + 1]]
        if len(q) < W.SHINGLE:  # too short to stand alone: the whole item is the question
            q, a = own, own[:0]
        shingles = np.unique(W.shingles(q, np.array([0, len(q)]))[0])
        size = 1 << max(4, int(len(own) - 1).bit_length())
        out.setdefault(size, []).append((rows[k].item_id, own, shingles, np.unique(a)))
    classes = []
    for items in out.values():
        lengths = np.array([len(i[1]) for i in items])
        words, slot = np.concatenate([i[1] for i in items]), np.repeat(np.arange(len(items)), lengths)
        order = np.lexsort((slot, words))
        words, slot = words[order], slot[order]
        first = np.flatnonzero((np.diff(slot, prepend=-1) != 0) | (np.diff(words, prepend=words[:1] ^ _U(1)) != 0))
        tf = np.diff(first, append=len(words)).astype(np.float64)
        words, slot = words[first], slot[first]
        begin = np.flatnonzero(np.diff(words, prepend=words[:1] ^ _U(1)) != 0)
        terms = words[begin]
        held = np.array([df[t] for t in terms.view(np.int64).tolist()], np.float64)
        idf = np.repeat(np.log(1 + (n - held + 0.5) / (held + 0.5)), np.diff(begin, append=len(words)))
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[slot] / mean))
        impact /= np.bincount(slot, weights=impact, minlength=len(items))[slot]
        classes.append(LengthClass(int(lengths.max()), [i[0] for i in items], [i[2] for i in items], [i[3] for i in items], terms,
                                   slot.astype(np.int32), impact.astype(np.float32), np.append(begin, len(words))))
    return classes


def build_index(items: DataFrame, limit: int = INDEX_BYTES) -> list[str]:
    """Files of the stored index of ``items (item_id, question, answer)``, in parts of about ``limit`` bytes of items; an item is never cut.

    Items without a word, or without an id, are left out; null parts of an item read as empty. The driver gets counts and names only.
    """
    items = materialize(items.select("item_id", text_of("question").alias("question"), text_of("answer").alias("answer"))
                        .where("item_id is not null"), "items")
    size = F.octet_length("question") + F.octet_length("answer")
    total = items.agg(F.sum(size)).first()[0] or 0
    if not total:
        return []
    terms, n, mean = term_statistics(items)
    parts = -(-total // limit)
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(parts)))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                words, starts = W.word_hashes(texts.slice(i, j - i))
                part = np.repeat(np.asarray(batch.column("part").slice(i, j - i)), np.diff(starts))
                found = np.unique(np.stack([part.astype(np.int64), words.view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["part", "term"])

    wanted = dealt.select("part", F.concat_ws("\n", "question", "answer").alias("text")).mapInArrow(distinct, "part long, term long")
    wanted = wanted.distinct().join(terms, "term").select("part", "term", "df")

    def build(rows: pa.Table, df: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"data": pa.array([], pa.binary())})
        held = dict(zip(df.column("term").to_pylist(), df.column("df").to_pylist(), strict=True))
        own = [_Item(**r) for r in rows.select(["item_id", "question", "answer"]).to_pylist()]
        return pa.table({"data": pa.array([pickle.dumps(_classes(own, held, n, mean))], pa.binary())})

    built = dealt.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(build, "data binary")
    return sorted(materialize(built, "index-parts").inputFiles())


@dataclass(frozen=True)
class _Item:
    item_id: object
    question: str
    answer: str


_HELD: dict[tuple[str, int], list[LengthClass]] = {}


def _parts(files: list[str]) -> Iterator[list[LengthClass]]:
    """The parts of the index, one after the other; a worker keeps those that fit its memory bound for its next batch."""
    for uri in files:
        if (uri, -1) not in _HELD:
            fs, path = _place(uri)
            with fs.open_input_file(path) as source:
                number = -1
                for number, batch in enumerate(pq.ParquetFile(source).iter_batches(1, columns=["data"])):
                    part = pickle.loads(batch.column("data")[0].as_py())
                    size = sum(c.size for c in part)
                    if sum(c.size for p in _HELD.values() for c in p) + size <= HELD_BYTES:
                        _HELD[uri, number] = part
                    yield part
                if all((uri, k) in _HELD for k in range(number + 1)):
                    _HELD[uri, -1] = []
                    _COUNTS[uri] = number + 1
            continue
        for number in range(_COUNTS[uri]):
            yield _HELD[uri, number]


_COUNTS: dict[str, int] = {}


def _search(texts: pa.Array, classes: list[LengthClass], score: float, overlap: float) -> list[tuple[int, object, float, float, float]]:
    """Verified hits (text, item, score, question overlap, answer overlap) of a batch of texts."""
    words, starts = W.word_hashes(texts)
    counts = np.diff(starts)
    text_of_word = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(words)) - starts[:-1][text_of_word]
    hits: list[tuple] = []
    for own in classes:
        half = own.longest
        place, term = own.lookup(words)
        if not len(place):
            continue
        # halves of passages: a passage is two that follow each other in a text
        halves = np.maximum(-(-counts // half), 1)
        first_half = np.cumsum(halves) - halves
        where = first_half[text_of_word[place]] + inside[place] // half
        keys = np.unique(where * len(own.terms) + term)
        where, term = np.divmod(keys, len(own.terms))
        n_halves = int(halves.sum())
        ends = np.searchsorted(where, np.arange(n_halves + 1))
        last = np.zeros(n_halves, bool)
        last[first_half + halves - 1] = True
        # first bound: the highest impact of each word in any item
        sums = np.bincount(where, weights=own.term_max[term], minlength=n_halves)
        pair = sums + np.where(last, 0, np.append(sums[1:], 0))
        passed = np.flatnonzero(pair >= score * (1 - 1e-5))
        slab = max(1, CELLS // max(own.blocks, 1))
        for first in range(0, len(passed), slab):
            some = passed[first: first + slab]
            # the distinct terms of each passage that is left
            low, high = ends[some], ends[np.where(last[some], some, some + 1) + 1]
            keys = np.unique(np.repeat(np.arange(len(some)), high - low) * len(own.terms) + term[_ranges(low, high)])
            holder, held = np.divmod(keys, len(own.terms))
            # second bound: the highest impact of each word in each block of items
            entry = _ranges(own.entries[held], own.entries[held + 1])
            cell = np.repeat(holder, own.entries[held + 1] - own.entries[held]) * own.blocks + own.block[entry]
            bounds = np.bincount(cell, weights=own.highest[entry], minlength=len(some) * own.blocks).reshape(len(some), own.blocks)
            reach = np.searchsorted(holder, np.arange(len(some) + 1))
            for place in np.flatnonzero((bounds >= score * (1 - 1e-5)).any(axis=1)).tolist():
                hits += _verified(own, int(some[place]), held[reach[place]: reach[place + 1]], words, starts, first_half, score, overlap)
    best: dict[tuple[int, object], tuple[float, float, float]] = {}
    for text, item, *found in hits:
        best[text, item] = max(best.get((text, item), tuple(found)), tuple(found))
    return [(*key, *value) for key, value in sorted(best.items(), key=lambda x: x[0][0])]


def _verified(own: LengthClass, h: int, terms: np.ndarray, words: np.ndarray, starts: np.ndarray, first_half: np.ndarray, score: float,
              overlap: float) -> Iterator[tuple]:
    """Hits of the passage that begins with half ``h`` and has the given terms."""
    half = own.longest
    for item, reached in own.candidates(terms, score):
        text = int(np.searchsorted(first_half, h, side="right")) - 1
        begin = int(starts[text]) + (h - int(first_half[text])) * half
        part = words[begin: min(begin + 2 * half, int(starts[text + 1]))]
        shingles, _ = W.shingles(part, np.array([0, len(part)]))
        question = np.isin(own.questions[item], shingles).mean()
        answer = np.isin(own.answers[item], part).mean() if len(own.answers[item]) else 1.0
        if question >= overlap and answer >= overlap:
            yield text, own.items[item], reached, float(question), float(answer)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", score: float = SCORE,
                 overlap: float = OVERLAP) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` for every document and test item whose passage it holds.

    Of several passages with one item the highest score is given. Null and empty texts hold nothing; rows with a null id are
    searched too; a repeated row is reported as often as it is given; without items or documents the result is empty.
    """
    kinds = (docs.schema[doc_id].dataType, items.schema["item_id"].dataType)
    schema = T.StructType([T.StructField("doc_id", kinds[0]), T.StructField("item_id", kinds[1]),
                           *[T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap", "answer_overlap")]])
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    files = build_index(items)
    if not files:
        return docs.sparkSession.createDataFrame([], schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[int, object], tuple[float, float, float]] = {}
            for row, item, *found in _hits(W.plain(batch.column("text")), files, score, overlap):
                best[row, item] = max(best.get((row, item), tuple(found)), tuple(found))
            if best:
                keys = sorted(best, key=lambda key: key[0])
                columns = [pa.array([key[1] for key in keys]), *(pa.array([best[key][k] for key in keys]) for k in range(3))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array([key[0] for key in keys])), *columns],
                                                 names=schema.names)

    return rows.mapInArrow(search, schema)


def _hits(texts: pa.Array, files: list[str], score: float, overlap: float) -> Iterator[tuple]:
    """Verified hits ``(row, item, score, question overlap, answer overlap)`` of a batch of texts with all parts of the index."""
    for part in _parts(files):
        for i, j in W.chunks(texts):
            for row, *found in _search(texts.slice(i, j - i), part, score, overlap):
                yield i + row, *found


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", score: float = SCORE,
                      overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no test item, as they are."""
    files = build_index(items)
    if not files:
        return docs

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in _hits(W.plain(batch.column(text)), files, score, overlap):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)


def with_parts(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Test items given as one text: the last sentence is the answer, what is before it the question."""
    whole = F.rtrim(text_of(text))
    answer = F.regexp_extract(whole, r"([^.!?\n]*[.!?]*)$", 1)
    return items.select(F.col(item_id).alias("item_id"), F.expr("null").cast("string").alias("_"), whole.alias("whole"),
                        answer.alias("answer")).select(
        "item_id", F.expr("substring(whole, 1, length(whole) - length(answer))").alias("question"), "answer")
