"""Quality grades by ordinal regression: a cumulative-link model over hashed text.

The grade y of a text has P(y <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, with ordered thresholds. x holds
the hashed words, word beginnings and pairs of signs that occur in the text, and a few hashed traits of its form (shares of signs,
capitals and digits, how often words repeat, length).
The thresholds are kept in order by fitting the logarithms of their gaps. The model is fitted on a bounded sample of labelled rows;
texts are scored by expected grade and by the probability of reaching each grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm import words as W
from affinis.llm.common import text_of

FEATURE_BITS = 17
STEM = 5
FIT_ROWS = 20_000
EPOCHS = 15
RATE = 0.3
PENALTY = 0.5
BATCH = 256
#: a feature of fewer rows of the sample gets no weight: the model would learn these rows by heart
LEAST_ROWS = 10
_U = np.uint64


@dataclass
class OrdinalModel:
    """Hashed weights and ascending thresholds; grades are 0 to ``len(thresholds)``."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(y >= k) for k = 1 ...: one column a threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


_CLASS = np.zeros(256, np.uint8)  # 1: sign, 2: capital, 3: digit, 4: blank
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of every text, each once, and where each text's begin."""
    words, starts = W.word_hashes(texts)
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(starts))
    keys = np.unique((owner << FEATURE_BITS) | (words >> _U(64 - FEATURE_BITS)).astype(np.int64))
    distinct = np.bincount(keys >> FEATURE_BITS, minlength=n)
    stems, _ = W.word_hashes(texts, STEM)
    stems = (owner << FEATURE_BITS) | (W.mix(stems + _U(STEM)) >> _U(64 - FEATURE_BITS)).astype(np.int64)
    raw, offsets = W.buffer(texts)
    marks = _CLASS[raw]
    pair = np.flatnonzero((marks[1:] == 1) & (marks[:-1] == 1))
    signs = (raw[pair].astype(_U) << _U(8)) | raw[pair + 1].astype(_U)
    holder = np.searchsorted(offsets, pair, side="right") - 1
    own = pair + 1 < offsets[holder + 1]
    signs = (holder[own] << FEATURE_BITS) | (W.mix(signs[own] + _U(1 << 20)) >> _U(64 - FEATURE_BITS)).astype(np.int64)
    total = np.maximum(np.diff(offsets), 1)
    ends = np.concatenate([[0], np.cumsum(marks == 1)]), np.concatenate([[0], np.cumsum(marks == 2)]), np.concatenate(
        [[0], np.cumsum(marks == 3)])
    shares = [(c[offsets[1:]] - c[offsets[:-1]]) / total for c in ends]
    repeats = 1 - distinct / np.maximum(np.diff(starts), 1)
    traits = [np.minimum((share * 40).astype(np.int64), 15) for share in (*shares, repeats)]
    traits.append(np.log2(total).astype(np.int64))
    hashed = [(W.mix((value + 1000 * (k + 1)).astype(_U)) >> _U(64 - FEATURE_BITS)).astype(np.int64)
              for k, value in enumerate(traits)]
    keys = np.unique(np.concatenate([keys, stems, signs, *[(np.arange(n) << FEATURE_BITS) | h for h in hashed]]))
    return keys & ((1 << FEATURE_BITS) - 1), np.searchsorted(keys, np.arange(n + 1) << FEATURE_BITS)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def fit_ordinal(columns: np.ndarray, starts: np.ndarray, grades: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> OrdinalModel:
    """Fit by AdaGrad on the log likelihood with a quadratic penalty; the same input gives the same model."""
    top = max(int(grades.max(initial=0)), 1)
    keep = (np.bincount(columns, minlength=1 << FEATURE_BITS) >= LEAST_ROWS)[columns]
    starts = np.concatenate([[0], np.cumsum(keep)])[starts]
    columns = columns[keep]
    share = np.array([(np.sum(grades <= k) + 0.5) / (len(grades) + 1) for k in range(top)])
    base = np.log(share / (1 - share))
    first, gaps = base[0], np.log(np.maximum(np.diff(base), 0.1))
    weights = np.zeros(1 << FEATURE_BITS)
    squares = np.full(1 << FEATURE_BITS, 1e-6)
    squares_t = np.full(top, 1e-6)
    random = np.random.default_rng(seed)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for _ in range(epochs):
        order = random.permutation(len(grades))
        for k in range(0, len(order), BATCH):
            rows = order[k: k + BATCH]
            lengths = (starts[1:] - starts[:-1])[rows]
            inner = np.concatenate([[0], np.cumsum(lengths)])
            at = columns[np.repeat(starts[:-1][rows] - inner[:-1], lengths) + np.arange(inner[-1])]
            scores = _sums(weights[at], inner)
            thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            y = grades[rows]
            cut = np.concatenate([[-np.inf], thresholds, [np.inf]])
            upper, lower = sigmoid(cut[y + 1] - scores), sigmoid(cut[y] - scores)
            p = np.maximum(upper - lower, 1e-12)
            d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
            slope = (d_upper - d_lower) / len(rows)  # of the loss by the score
            gradient = np.bincount(at, weights=np.repeat(slope, lengths), minlength=1 << FEATURE_BITS) + PENALTY * weights / len(rows)
            squares += gradient * gradient
            weights -= RATE * gradient / np.sqrt(squares)
            by_cut = np.array([np.sum(np.where(y == j + 1, d_lower, 0) - np.where(y == j, d_upper, 0)) for j in range(top)]) / len(rows)
            tail = np.cumsum(by_cut[::-1])[::-1]
            step = np.concatenate([[tail[0]], tail[1:] * np.exp(gaps)])
            squares_t += step * step
            step = RATE * step / np.sqrt(squares_t)
            first, gaps = first - step[0], np.clip(gaps - step[1:], -5, 5)
    return OrdinalModel(weights.astype(np.float32), first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def train(docs: DataFrame, grades: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = FIT_ROWS) -> OrdinalModel:
    """Fit on about ``limit`` of the documents that ``grades (doc_id, grade)`` covers, picked by a hash of the id.

    The sample's feature numbers are fitted in one task, and the driver gets the weights. Rows with a null id or grade are passed
    over; without rows the weights are zero.
    """
    known = grades.where("doc_id is not null and grade is not null")
    part = min(1.0, limit / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))
    known = known.groupBy("doc_id").agg(F.max("grade").cast("long").alias("grade"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                columns, starts = features(texts.slice(i, j - i))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(columns, pa.int32()))
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([own.column("mark"), own.column("grade"), lists], names=["mark", "grade", "columns"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        parts = [b.column("columns") for b in held]
        sizes = np.concatenate([np.diff(np.asarray(p.offsets)) for p in parts]) if held else np.zeros(0, np.int64)
        columns = np.concatenate([np.asarray(p.flatten()) for p in parts]) if held else np.zeros(0, np.int32)
        keys = [np.concatenate([np.asarray(b.column(c)) for b in held]) if held else np.zeros(0, np.int64) for c in ("mark", "grade")]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        # the same order, whatever the partitions were
        order = np.lexsort((_sums(columns, starts), sizes, keys[1], keys[0]))
        lengths = sizes[order]
        inner = np.concatenate([[0], np.cumsum(lengths)])
        columns = columns[np.repeat(starts[:-1][order] - inner[:-1], lengths) + np.arange(inner[-1])]
        model = fit_ordinal(columns, inner, keys[1][order].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.thresholds.tolist()])],
                                         names=["weights", "thresholds"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).join(known, "doc_id")
    sample = rows.select(F.xxhash64("doc_id").alias("mark"), "grade", "text").mapInArrow(
        extract, "mark long, grade long, columns array<int>")
    # one task holds the bounded sample
    found = sample.repartition(1).mapInArrow(fit, "weights binary, thresholds array<double>").first()
    if found is None:
        return fit_ordinal(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
    return OrdinalModel(np.frombuffer(bytes(found.weights), np.float32), np.array(found.thresholds))


def score(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``(doc_id, expected_grade, p_at_least, selected)`` for every row of ``docs``.

    ``p_at_least[k - 1]`` is the probability of grade k or more; a text is selected if it reaches the top grade with probability
    ``least``. Null and empty texts are scored by their form alone. Null ids and repeated rows are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**FEATURE_BITS weights

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                columns, starts = features(texts.slice(i, j - i))
                tails = own.tails(_sums(own.weights[columns], starts))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * tails.shape[1], pa.int32()), pa.array(tails.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(tails.sum(axis=1)), lists,
                                                  pa.array(tails[:, -1] >= least)],
                                                 names=["doc_id", "expected_grade", "p_at_least", "selected"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(rate, f"doc_id {kind}, expected_grade double, p_at_least array<double>, selected boolean")
