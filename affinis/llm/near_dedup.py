"""Near-duplicate documents by BagMinHash signatures, banding and exact verification.

A text is the multiset of its five-word shingles; two texts are linked if their weighted Jaccard similarity (sum of the lesser
over sum of the greater counts) is at least ``threshold``. Classes are the connected components of the links.

Signature. The weight of a shingle is discretised at 1, 2, 4, ...; each interval (0,1], (1,2], (2,4], ... has its own Poisson
process, seeded by shingle and interval, whose rate is the interval's length. Each point has a time, a register and, from
successive halvings, a place in the interval; a weight that ends inside an interval keeps the points below it. Register k holds the
earliest kept point that fell on it, so two registers agree with exactly the weighted Jaccard similarity as probability. A process
ends as soon as its time exceeds the latest register of its text: long texts cost about one point a shingle.

Candidates are texts that share a band of registers. Equal texts count once. First each bucket is compared with its
best-connected member only, then what is still apart with a member drawn at random in each bucket; that settles groups of copies in
linear work. Then buckets that still hold several classes have members of different classes compared. A bucket of up to ``CROWDED``
members is paired as a whole. Members of larger ones mostly meet by a passage that many texts share, so they are paired only where they share one of
their rare elements, at a place in both texts that leaves room for the overlap they need: every pair at the threshold does, and texts of one
passage don't, whose rare elements are their own. Rare is what a table of ``2 ** COUNTER_BITS`` counters says; any order is right,
a good one is fast. The commonest class at an element isn't paired with itself. Pairs whose sizes or sketches (one byte a register) rule
out the threshold go before verification. Every candidate is verified on the exact multisets. Texts of no candidate are kept out
of that by a bitmap of fixed size; what it lets through by chance goes in the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm import words as W
from affinis.llm.common import components, fingerprint, merged_components, text_of, unused
from affinis.llm.tokens import release
from affinis.operators.staging import materialize, self_pairs, spread_join

THRESHOLD = 0.8
BANDS, ROWS = 56, 7
SKETCH = 96
FILTER_BITS = 25
COUNTER_BITS = 18
CROWDED = 8
_U = np.uint64
ELEMENT_BITS = 52


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Text number, shingle (52 bits) and count of every distinct shingle, sorted; and the number of texts."""
    hashes, text = W.shingles(*W.word_hashes(texts))
    low = _U(64 - ELEMENT_BITS)
    if len(texts) < 1 << (64 - ELEMENT_BITS):
        keys = np.sort((text.astype(_U) << _U(ELEMENT_BITS)) | (hashes >> low))
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ _U(1))) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(first, append=len(keys))
        keys = keys[first]
        return (keys >> _U(ELEMENT_BITS)).astype(np.int64), keys & _U((1 << ELEMENT_BITS) - 1), counts, len(texts)
    order = np.lexsort((hashes >> low, text))
    text, hashes = text[order], (hashes >> low)[order]
    first = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(hashes, prepend=hashes[:1] ^ _U(1)) != 0))
    return text[first], hashes[first], np.diff(first, append=len(text)), len(texts)


def signatures(texts: pa.Array, registers: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """BagMinHash signatures (texts x registers, 64-bit) and the total weight of every text; a text without words has zeros."""
    text, shingle, count, n = bags(texts)
    weight = np.bincount(text, weights=count, minlength=n).astype(np.int64)
    # one process for each interval that the weight reaches into: (0,1], (1,2], (2,4], ...
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    owner = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    floor = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    length = np.maximum(floor, 1)
    kept = np.minimum(count[owner] - floor, length)
    state = W.mix(shingle[owner] + W.mix(level.astype(_U) + _U(seed << 8)))
    text = text[owner]
    time = np.zeros(len(owner))
    earliest = np.full(n * registers, np.inf)
    chosen = np.zeros(n * registers, _U)
    latest = np.full(n, np.inf)
    step = 0
    while len(owner):
        step += 1
        draw = W.mix(state + _U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)) / length
        alive = time < latest[text]
        owner, text, time, state, length, kept, draw = (x[alive] for x in (owner, text, time, state, length, kept, draw))
        point = W.mix(draw)
        register = text * registers + ((point >> _U(32)) * _U(registers) >> _U(32)).astype(np.int64)
        # lengths are powers of two: the low bits are the outcomes of the halvings
        inside = (point & (length - 1).astype(_U)).astype(np.int64) < kept
        register, at, point = register[inside], time[inside], point[inside]
        np.minimum.at(earliest, register, at)
        won = earliest[register] == at
        chosen[register[won]] = point[won]
        latest = earliest.reshape(n, registers).max(axis=1)
    return chosen.reshape(n, registers), weight


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).reshape(-1).view(np.int64))


def _sketcher(bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                part = texts.slice(i, j - i)
                signature, weight = signatures(part, bands * rows)
                band = np.zeros((len(part), bands), _U)
                for row in range(rows):
                    band = W.mix(band + signature[:, row::rows])
                band = W.mix(band + np.arange(bands, dtype=_U))
                low = pa.FixedSizeBinaryArray.from_buffers(pa.binary(min(SKETCH, bands * rows)), len(part), [
                    None, pa.py_buffer(np.ascontiguousarray(signature[:, :SKETCH].astype(np.uint8)).tobytes())])
                yield pa.RecordBatch.from_arrays([
                    batch.column("fp").slice(i, j - i), pa.array(weight), low.cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * bands, pa.int32()), _signed(band)),
                ], names=["fp", "weight", "sketch", "bands"])
    return sketch


def _element_maker(wanted: np.ndarray):
    """Elements of every text whose bit is set; the k-th occurrence of a shingle is an element of its own, so sets show multiset overlap."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            bit = np.asarray(batch.column("bit"))
            hit = np.flatnonzero((wanted[bit >> 6] >> (bit & 63).astype(_U)) & _U(1))
            fps = batch.column("fp").take(pa.array(hit)).to_pylist()
            fresh = [k for k, fp in zip(hit.tolist(), fps, strict=True) if not (fp in done or done.add(fp))]
            texts = W.plain(batch.column("text").take(pa.array(fresh, pa.int64())))
            own = batch.column("fp").take(pa.array(fresh, pa.int64()))
            if len(done) > 1 << 17:  # a repeat after this is dropped later
                done.clear()
            for i, j in W.chunks(texts):
                text, shingle, count, n = bags(texts.slice(i, j - i))
                owner = np.repeat(np.arange(len(text)), count)
                k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                element = np.where(k > 0, W.mix(shingle[owner] + W.mix(k.astype(_U))), shingle[owner])
                ends = np.searchsorted(text[owner], np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([
                    own.slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(element))],
                    names=["fp", "elements"])
    return make


def _bit() -> Column:
    return F.xxhash64("fp").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """Bits of the wanted fingerprints: 2**FILTER_BITS bits, however many there are."""
    bits = wanted.select(_bit().alias("bit"))
    word = F.shiftright("bit", 6)
    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    rows = bits.groupBy(word.alias("word")).agg(F.bit_or(set_).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bitmap.view(_U)


def _alike(registers: int, least: int):
    """Keeps pairs of which at least ``least`` of the one-byte registers agree."""
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, registers)
                    for c in ("sketch_a", "sketch_b"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("id_a", "id_b")], names=["a", "b"])
    return alike


def near_duplicate_classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS,
                           rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """``(fp, id, label)`` of every distinct text that has a near duplicate, and the verified links ``(a, b, similarity)`` of ids.

    ``fp`` is ``fingerprint(text)``, ``label`` the class; texts that are not listed are alone. Null and empty texts, and texts
    without a word, are linked with nothing but equal texts. The links join each class; other pairs inside it aren't listed.

    A pair at similarity s is missed with probability (1 - s**rows)**bands, 2e-6 at 0.8 with the defaults.
    """
    registers = bands * rows
    texts = docs.select(fingerprint(text).alias("fp"), text_of(text).alias("text"))
    found = texts.mapInArrow(_sketcher(bands, rows), "fp binary, weight long, sketch binary, bands array<long>")
    distinct = found.where("weight > 0").groupBy("fp").agg(*[F.first(c).alias(c) for c in ("weight", "sketch", "bands")])
    # numbers are taken from the stored rows, so they stay the same however often these are read
    sigs = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "signatures")

    members = sigs.select("id", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(members.join(sizes, "band"), "buckets")
    elements = _elements(members.select("id").distinct().join(sigs.select("id", "fp"), "id"), texts)
    light = sigs.select("id", "weight", "sketch")
    # the text that shares most buckets with others is compared with each of them first
    degree = members.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "id").select("band", "id", F.struct("degree", "id").alias("rank"), F.col("id").alias("label"))
    links = _verified(_star(ranked, light, registers, threshold), elements, threshold)
    labels = components(links.select("a", "b"))
    # then what is still apart with another member of the class it may belong to, drawn at random in each bucket
    mixed = _mixed(members, labels)
    ranked = mixed.withColumn("rank", F.struct(F.xxhash64("band", "id").alias("draw"), "id"))
    found = _verified(_star(ranked, light, registers, threshold), elements, threshold)
    links, labels = links.unionByName(found), merged_components(labels, found.select("a", "b"))

    # pairs of different classes that still share a bucket
    rest = _mixed(mixed, labels).join(light.select("id", "weight"), "id")
    rest = materialize(rest.select("band", "id", "label", "weight"), "mixed-buckets")
    sizes = rest.groupBy("band").agg(F.count(F.lit(1)).alias("_rows"))
    apart = (F.col("label_a") != F.col("label_b")) & _sizes_allow("weight_a", "weight_b", threshold)
    small = materialize(rest.join(sizes.where(F.col("_rows") <= CROWDED).select("band"), "band"), "small-buckets")
    pairs = self_pairs(small, ["band"], "id", ("label", "weight"), apart).select("id_a", "id_b")
    crowded = rest.join(sizes.where(F.col("_rows") > CROWDED).select("band"), "band").select("id", "label").distinct()
    pairs = pairs.unionByName(_rare_pairs(materialize(crowded, "crowded"), elements, threshold)).distinct()
    found = _verified(_sketches_allow(_with_sketches(pairs, light), registers, threshold), elements, threshold)
    links, labels = links.unionByName(found), merged_components(labels, found.select("a", "b"))
    named = sigs.select("fp", F.col("id").alias("node"))
    classes = labels.join(named, "node").select("fp", F.col("node").alias("id"), "label")
    return materialize(classes, "classes"), links


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``band, id, label`` of the buckets that hold several classes."""
    sides = members.select("band", "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    sides = materialize(sides.withColumn("label", F.coalesce("label", "id")), "sides")
    mixed = sides.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return sides.join(mixed.select("band"), "band")


def _sizes_allow(a: str, b: str, threshold: float) -> Column:
    return F.least(a, b) >= F.lit(threshold - 1e-6) * F.greatest(a, b)


def _star(ranked: DataFrame, light: DataFrame, registers: int, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of each bucket's highest-ranked member with those of other classes, where sizes and sketches allow it."""
    centre = ranked.groupBy("band").agg(F.max(F.struct("rank", "label")).alias("best")).select(
        "band", F.col("best.rank.id").alias("centre"), F.col("best.label").alias("centre_label"))
    star = ranked.join(centre, "band").where("label <> centre_label").select(
        F.least("id", "centre").alias("id_a"), F.greatest("id", "centre").alias("id_b")).distinct()
    return _sketches_allow(_with_sketches(star, light).where(_sizes_allow("weight_a", "weight_b", threshold)), registers, threshold)


def _with_sketches(pairs: DataFrame, light: DataFrame) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(light.select(*[F.col(c).alias(f"{c}_{side}") for c in light.columns]), f"id_{side}")
    return pairs


def _slot(elements: np.ndarray) -> np.ndarray:
    """Counter of each element."""
    return (W.mix(elements.view(_U)) >> _U(64 - COUNTER_BITS)).astype(np.int64)


def _counters(own: DataFrame) -> np.ndarray:
    """How often the elements of each counter occur: ``2 ** COUNTER_BITS`` numbers, however many elements there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            total += np.bincount(_slot(np.asarray(batch.column("elements").flatten())), minlength=1 << COUNTER_BITS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    rows = own.select("elements").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << COUNTER_BITS, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def _prefix_maker(counters, threshold: float):
    """The rarest elements of every text, enough that two similar texts share one; ``reach`` counts from an element to the common end."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("elements")
            values, ends = np.asarray(lists.flatten()), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            sizes = np.diff(ends)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, counters.value[_slot(values)], owner))
            reach = ends[1:][owner] - np.arange(len(values))
            kept = reach >= threshold * sizes[owner] - 1e-6
            at = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays([pa.array(values[order][kept]), batch.column("id").take(at), batch.column("label").take(at),
                                              pa.array(sizes[owner][kept].astype(np.int64)), pa.array(reach[kept].astype(np.int64))],
                                             names=["element", "id", "label", "n", "reach"])
    return make


def _rare_pairs(crowded: DataFrame, elements: DataFrame, threshold: float, block: int = 2000) -> DataFrame:
    """Pairs ``(id_a, id_b)`` of different classes among ``crowded (id, label)`` that share a rare element with room for their overlap.

    At the rarest element that two texts share, ``reach`` bounds their overlap, which has to be t / (1 + t) of both sizes together.
    """
    if crowded.isEmpty():
        return crowded.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"))
    own = materialize(elements.join(crowded, "id"), "crowded-elements")
    counters = own.sparkSession.sparkContext.broadcast(_counters(own))
    prefix = own.select("id", "label", "elements").mapInArrow(
        _prefix_maker(counters, threshold), "element long, id long, label long, n long, reach long")
    prefix = materialize(prefix, "rare-elements")
    per_class = prefix.groupBy("element", "label").agg(F.count(F.lit(1)).alias("rows"))
    keys = per_class.groupBy("element").agg(F.max(F.struct("rows", "label")).alias("most"), F.count(F.lit(1)).alias("classes"))
    keys = materialize(keys.where("classes > 1").select("element", F.col("most.label").alias("major")), "shared-elements")
    rows = materialize(prefix.join(keys, "element"), "shared-rows")
    right = rows.select("element", *[F.col(c).alias(f"{c}_b") for c in ("id", "label", "n", "reach", "major")])
    t = F.lit(threshold)
    room = F.least("reach_a", "reach_b") * (1 + t) >= t * (F.col("n_a") + F.col("n_b")) - 1e-6
    once = (F.col("label_b") == F.col("major_b")) | (F.col("id_a") < F.col("id_b"))
    condition = (F.col("label_a") != F.col("label_b")) & once & _sizes_allow("n_a", "n_b", threshold) & room
    minor = materialize(rows.where("label <> major"), "minor-rows")
    left = minor.select("element", *[F.col(c).alias(f"{c}_a") for c in ("id", "label", "n", "reach")])
    found = spread_join(left, right, ["element"], condition, block)
    return found.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def _sketches_allow(pairs: DataFrame, registers: int, threshold: float) -> DataFrame:
    """Distinct ``(a, b)`` of the pairs whose sketches are at most six standard deviations from the threshold.

    That loses less than banding does.
    """
    shown = min(registers, SKETCH)
    least = int(shown * (threshold - 6 * (threshold * (1 - threshold) / shown) ** 0.5))
    return pairs.select("id_a", "id_b", "sketch_a", "sketch_b").mapInArrow(_alike(shown, least), "a long, b long").distinct()


def _elements(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """``(id, elements)`` of the wanted ``(id, fp)``, stored; other texts are left out by a bitmap of their fingerprints."""
    wanted = materialize(wanted, "wanted")
    likely = texts.select("fp", _bit().alias("bit"), "text").mapInArrow(
        _element_maker(_bitmap(wanted)), "fp binary, elements array<long>")
    return materialize(likely.join(wanted, "fp").groupBy("id").agg(F.first("elements").alias("elements")), "elements")


def _verified(pairs: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose exact weighted Jaccard similarity reaches the threshold, with it; stored."""
    pairs = materialize(pairs, "candidates")
    for side in "ab":
        pairs = pairs.join(elements.select(F.col("id").alias(side), F.col("elements").alias(f"elements_{side}")), side)
    pairs = pairs.withColumn("common", F.size(F.array_intersect("elements_a", "elements_b")).cast("long"))
    total = (F.size("elements_a") + F.size("elements_b")).cast("long")  # an element for each occurrence
    similarity = F.col("common") / (total - F.col("common"))
    return materialize(pairs.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= F.lit(threshold)), "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, class_id, class_rows)`` for every row of ``docs``.

    ``class_id`` is the least ``doc_id`` of the class (null ids are passed over while there is another), ``class_rows`` the number of
    rows in it. Rows of equal text are one class; null and empty texts are one class. A repeated row is returned as often as it is given; an
    empty table gives none.
    """
    classes, _ = near_duplicate_classes(docs, text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("fp")).join(classes.select("fp", "label"), "fp", "left")
    rows = materialize(rows.select("doc_id", _class_key().alias("class")), "rows")
    groups = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    return rows.join(groups, "class").select("doc_id", "class_id", "class_rows")


def _class_key():
    """Names a class: its label, or the fingerprint of a text that is alone."""
    return F.coalesce(F.col("label").cast("string"), F.hex("fp"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for every class: the one of least ``doc_id`` (nulls last), then of least row fingerprint.

    All columns are returned as they are. Of wholly equal rows one stays.
    """
    classes, _ = near_duplicate_classes(docs, text, **options)
    fp, row, mult = (unused(docs, n) for n in ("_fp", "_row", "_mult"))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    keyed = docs.withColumn(fp, fingerprint(text)).withColumn(row, F.xxhash64(*others, *[c.isNull() for c in others]))
    narrow = keyed.select(F.col(fp).alias("fp"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    key = F.struct(F.col("id").isNull().alias("none"), "id", "fp", "row")
    best = narrow.join(classes.select("fp", "label"), "fp", "left").groupBy(_class_key().alias("class")).agg(
        F.min(key).alias("best")).select("best.fp", "best.row")
    counts = narrow.groupBy("fp", "row").agg(F.count(F.lit(1)).alias("mult"))
    best = materialize(best.join(counts, ["fp", "row"]), "kept").withColumnsRenamed({"fp": fp, "row": row, "mult": mult})
    kept = keyed.join(best, [fp, row])
    once = kept.where(F.col(mult) == 1).select(*docs.columns)
    if best.where(F.col(mult) > 1).isEmpty():
        return once
    return once.unionByName(kept.where(F.col(mult) > 1).dropDuplicates([fp, row]).select(*docs.columns))
