"""Language identification by Bayesian fusion of text, markup, address suffix and host.

Text. A naive Bayes model over hashed byte trigrams of the lower-cased words (none with a digit), trained on labelled rows, gives a
likelihood of the text for each language, and a flat distribution stands for "any other" (``und``). Trigrams overlap and repeat, so
a text counts as ``EVIDENCE`` trigrams at most.

Declared language and address suffix. How often each declared tag and each last label of a host name goes with each language is
counted over all records, with the text's own best language as the guide, and smoothed.

Host. The languages found on a host are counted in the same way. The prior of a host is shrunk towards that of its domain, the
domain's towards that of all records. A record does not count towards its own prior.

The posterior is the normalised product. All counts are grouped aggregates with map-side combine; a host with a third of all rows
is one row there, and joins with it have a unique side.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm import words as W
from affinis.llm.common import text_of, unused
from affinis.llm.tokens import release
from affinis.operators.staging import materialize

TRAIN_ROWS = 4000
LABEL_ROWS = 50
MOST_LABELS = 200
GRAM_BITS = 15
EVIDENCE = 100
SMOOTH = 0.1
STRENGTH = 10.0
OTHER = "und"
LEAST = 0.5


@dataclass
class LanguageModel:
    """Log probabilities of hashed trigrams: one column a language, then the flat one; the last row is for no trigram."""

    languages: list[str]
    table: np.ndarray


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams (one for each byte; those that leave a text or hold a digit have the last number) and text offsets."""
    space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    raw, offsets = W.spaced(pc.binary_join_element_wise(space, texts, none))
    # runs of blanks count as one
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    keep[offsets[:-1]] = True
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    raw = raw[keep].astype(np.uint32)
    code = raw << np.uint32(16)
    code[:-1] |= raw[1:] << np.uint32(8)
    code[:-2] |= raw[2:]
    gram = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
    digit = (raw >= 48) & (raw <= 57)  # digits tell no language
    gram[digit] = 1 << GRAM_BITS
    gram[:-1][digit[1:]] = 1 << GRAM_BITS
    gram[:-2][digit[2:]] = 1 << GRAM_BITS
    gram[offsets[1:] - 1] = 1 << GRAM_BITS
    gram[np.maximum(offsets[1:] - 2, offsets[:-1])] = 1 << GRAM_BITS
    return gram, offsets


def label_bound(counts: list[int], limit: int) -> float:
    """The most rows of a label, so that all labels together have about ``limit``; at least LABEL_ROWS. Rarer labels are taken whole."""
    left, bound = float(limit), float("inf")
    for k, n in enumerate(sorted(counts)):
        bound = left / (len(counts) - k)
        if n > bound:
            return max(bound, LABEL_ROWS)
        left -= n
    return float("inf")


def train(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", limit: int = TRAIN_ROWS) -> LanguageModel:
    """Fit the text model on about ``limit`` rows that have a label: the same number of each label, and all rows of rarer ones.

    A label counts by its primary subtag, and the ``MOST_LABELS`` commonest ones are languages; that bounds the model. Rows of a label are
    picked by a hash of key and text. Only label counts and counts of hashed trigrams by language come to the
    driver. Without labelled rows the model knows no language.
    """
    labelled = rows.select(F.col(key).alias("key"), text_of(text).alias("text"), _tag(F.col(label)).alias("label")).where("label is not null")
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.orderBy(F.desc("n"), "label").limit(MOST_LABELS + 1).collect()
    counts = {r.label: r.n for r in ranked[:MOST_LABELS]}
    if len(ranked) > MOST_LABELS:
        labelled = labelled.where(F.col("label").isin(list(counts)))
    most = label_bound(list(counts.values()), limit)
    cuts = [(name, int(most / n * (1 << 40))) for name, n in counts.items() if n > most]
    sample = labelled
    if cuts:
        cuts = F.broadcast(rows.sparkSession.createDataFrame(cuts, "_label string, _below long"))
        place = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 40))
        sample = sample.join(cuts, F.col("label") == F.col("_label"), "left").where(F.col("_below").isNull() | (place < F.col("_below")))
    sample = sample.select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = W.plain(batch.column("text")), np.array(batch.column("label").to_pylist(), object)
            for i, j in W.chunks(texts):
                gram, offsets = _grams(texts.slice(i, j - i))
                names = np.repeat(labels[i:j], np.diff(offsets))
                for name in sorted(set(labels[i:j])):
                    n = np.bincount(gram[names == name], minlength=(1 << GRAM_BITS) + 1)[:-1]
                    used = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(n[used])],
                                                     names=["label", "gram", "n"])

    counts = sample.mapInArrow(count, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["label"].unique())
    table = np.full(((1 << GRAM_BITS) + 1, len(languages) + 1), -np.log(1 << GRAM_BITS), np.float64)
    for k, name in enumerate(languages):
        own = found[found["label"] == name]
        n = np.full(1 << GRAM_BITS, SMOOTH)
        n[own["gram"].to_numpy()] += own["n"].to_numpy()
        table[:-1, k] = np.log(n / n.sum())
    table[-1] = 0
    return LanguageModel(languages, table.astype(np.float32))


def text_evidence(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of every text for each language and the flat model, and its number of trigrams."""
    gram, offsets = _grams(texts)
    ranks = len(model.languages) + 1
    if not len(texts):
        return np.zeros((0, ranks)), np.zeros(0, np.int64)
    sums = np.stack([np.add.reduceat(model.table[gram, k].astype(np.float64), offsets[:-1]) for k in range(ranks)], axis=1)
    n = np.add.reduceat((gram < 1 << GRAM_BITS).astype(np.int64), offsets[:-1])
    return sums * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None], n


def _with_evidence(records: DataFrame, text: str, evidence: str, model: LanguageModel) -> DataFrame:
    shared = records.sparkSession.sparkContext.broadcast(model)  # 2**GRAM_BITS rows, a column a language

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts = W.plain(batch.column(text))
            for i, j in W.chunks(texts):
                sums, n = text_evidence(texts.slice(i, j - i), shared.value)
                sums[n == 0] = np.nan
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * sums.shape[1], pa.int32()),
                                                 pa.array(sums.reshape(-1)))
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*own.columns, lists], names=[*own.schema.names, evidence])

    schema = T.StructType([*records.schema.fields, T.StructField(evidence, T.ArrayType(T.DoubleType()))])
    return records.mapInArrow(add, schema)


def _best(scores: str) -> Column:
    """Place of the highest score; null for a text without trigrams."""
    return F.when(~F.isnan(F.col(scores)[0]), F.array_position(F.col(scores), F.array_max(scores)).cast("int") - 1)


def _suffix(host: Column) -> Column:
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


class Fusion:
    """Counts over all records, joined to any of them."""

    def __init__(self, narrow: DataFrame, ranks: int):
        """``narrow``: a stored table of ``scores, declared, host``."""
        self.ranks = ranks
        rows = narrow.select(_best("scores").alias("best"), "declared", _suffix(F.col("host")).alias("suffix"),
                             _domain(F.col("host")).alias("domain"), "host").where("best is not null")
        counts = F.array(*[F.count_if(F.col("best") == k) for k in range(ranks)])
        self.total = rows.agg(counts.alias("n")).first().n
        self.by = {name: materialize(rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_key")).agg(
            counts.alias(f"_n_{name}")), f"language-{name}") for name in ("declared", "suffix", "domain", "host")}
        self.kinds = {name: self.by[name].count() for name in ("declared", "suffix")}

    def posterior(self, rows: DataFrame, scores: str, declared: Column, host: Column) -> DataFrame:
        """Adds ``_posterior``, an array of probabilities (null for a text without trigrams)."""
        names = rows.columns
        keys = {"declared": declared, "suffix": _suffix(host), "domain": _domain(host), "host": host}
        joined = rows.withColumns({f"_k_{n}": c for n, c in keys.items()}).withColumn("_best", _best(scores))
        for name, counts in self.by.items():
            joined = joined.join(counts, F.col(f"_k_{name}") == F.col("_key"), "left").drop("_key")
        size = float(sum(self.total))
        prior = [(self.total[k] + 1.0) / (size + self.ranks) for k in range(self.ranks)]
        logs = []
        for k in range(self.ranks):
            own = F.when(F.col("_best") == k, 1).otherwise(0)
            p = F.lit(prior[k])
            for level in ("domain", "host"):  # without the record itself
                n = F.col(f"_n_{level}")
                others = F.greatest(F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x) - 1, F.lit(0))
                shrunk = (F.greatest(n[k] - own, F.lit(0)) + F.lit(STRENGTH) * p) / (others + F.lit(STRENGTH))
                p = F.coalesce(shrunk, p)
            log = F.col(scores)[k] + F.log(p)
            for name, kinds in self.kinds.items():
                n = F.greatest(F.col(f"_n_{name}")[k] - own, F.lit(0))
                log = log + F.coalesce(F.log((n + 1.0) / F.lit(self.total[k] + kinds + 1.0)), F.lit(0.0))
            logs.append(log)
        joined = joined.withColumn("_logs", F.array(*logs)).withColumn("_top", F.array_max("_logs"))
        odds = F.transform("_logs", lambda x: F.exp(x - F.col("_top")))
        joined = joined.withColumn("_odds", F.when(F.col("_best").isNotNull(), odds))
        total = F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x)
        return joined.withColumn("_posterior", F.transform("_odds", lambda x: x / total)).select(*names, "_posterior")


def _tag(column: Column) -> Column:
    """Primary subtag of a declared language; null if there is none."""
    tag = F.regexp_extract(F.lower(F.trim(column.cast("string"))), "^([a-z]{2,8})", 1)
    return F.when(tag != "", tag)


def identify(records: DataFrame, model: LanguageModel, least: float = LEAST) -> DataFrame:
    """Language of every record; ``text``, ``declared`` and ``host`` are read, all other columns are handed on.

    Adds ``language``, ``probability`` and ``accepted``. A text without a letter, null or empty, has language ``und``, probability 0
    and is not accepted; nor is one whose best language is ``und`` or less probable than ``least``. A null or unknown tag, suffix or
    host is no evidence. Repeated rows are kept.
    """
    rows = records.select(*[c for c in records.columns if c not in ("declared", "host")],
                          _tag(F.col("declared")).alias("declared"), F.lower(F.col("host").cast("string")).alias("host"))
    narrow = materialize(_with_evidence(rows, "text", "scores", model).drop("text"), "language-evidence")
    fusion = Fusion(narrow, len(model.languages) + 1)
    done = fusion.posterior(narrow, "scores", F.col("declared"), F.col("host"))
    return _named(done, model, least).drop("scores", "_posterior")


def _named(rows: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    names = F.array(*[F.lit(n) for n in (*model.languages, OTHER)])
    place = F.array_position("_posterior", F.array_max("_posterior")).cast("int")
    rows = rows.withColumn("language", F.coalesce(F.element_at(names, place), F.lit(OTHER)))
    rows = rows.withColumn("probability", F.coalesce(F.array_max("_posterior"), F.lit(0.0)))
    return rows.withColumn("accepted", (F.col("language") != OTHER) & (F.col("probability") >= least))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", declared: str = "lang", host: str = "source",
                    least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, as they are."""
    scores, top = unused(docs, "_scores"), unused(docs, "_whole")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(top), text_of(text).alias("text"),
                        _tag(F.col(declared)).alias("declared"), F.lower(F.col(host).cast("string")).alias("host"))
    narrow = whole.select("text", "declared", "host")
    narrow = materialize(_with_evidence(narrow, "text", "scores", model).drop("text"), "language-evidence")
    fusion = Fusion(narrow, len(model.languages) + 1)
    scored = _with_evidence(whole, "text", scores, model).drop("text")
    found = _named(fusion.posterior(scored, scores, F.col("declared"), F.col("host")), model, least)
    return found.where("accepted").select(f"{top}.*")


_OPEN = re.compile(r"<(?:(script|style)\b|(!--))?", re.IGNORECASE)
#: what ends a script, a style sheet, a comment and any other tag
_CLOSE = {"script": re.compile(r"</script\s*>", re.IGNORECASE), "style": re.compile(r"</style\s*>", re.IGNORECASE),
          "!--": re.compile("-->"), "": re.compile(">")}
_ROOT = re.compile(r"<html\b", re.IGNORECASE)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.IGNORECASE)


def visible_text(page: str) -> str:
    """The page without scripts, style sheets, comments and tags, each a blank; what isn't closed is a tag, or text if that isn't, either.

    One pass: what has no end behind one place has none behind a later one.
    """
    out, at, place, endless = [], 0, 0, set()
    while found := _OPEN.search(page, place):
        place = found.end()
        for kind in dict.fromkeys(((found[1] or found[2] or "").lower(), "")):
            if kind in endless:
                continue
            close = _CLOSE[kind].search(page, found.end() if kind else found.start() + 1)
            if close:
                out += [page[at: found.start()], " "]
                at = place = close.end()
                break
            endless.add(kind)
        if "" in endless and len(endless) == len(_CLOSE):
            break
    return html.unescape("".join([*out, page[at:]]))


def declared_language(page: str) -> str | None:
    """The ``lang`` of the first root tag that has one."""
    place = 0
    while found := _ROOT.search(page, place):
        end = page.find(">", found.end())
        end = len(page) if end < 0 else end
        if lang := _LANG.search(page, found.end(), end):
            return lang[1]
        place = end
    return None


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """``(page_id, text, declared, host)``: visible text, declared language and host name of web pages; null markup reads as empty."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, tags = [], []
            for page in batch.column("html").to_pylist():
                page = page or ""
                tags.append(declared_language(page))
                texts.append(visible_text(page))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string()), pa.array(tags, pa.string()),
                                              batch.column("host")], names=["page_id", "text", "declared", "host"])

    host = F.regexp_extract(F.lower(F.col(url).cast("string")), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(markup).cast("string").alias("html"),
                        F.when(host != "", host).alias("host"))
    return rows.mapInArrow(read, f"page_id {kind}, text string, declared string, host string")
