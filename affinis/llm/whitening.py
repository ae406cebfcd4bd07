"""Whitening of embeddings by an incremental eigendecomposition, combined over partitions and refined over all rows.

Vectors are read as whole numbers, ``floor(1024 * c) + 100000``, so sums and deviations are exact. A spectrum is the number of vectors,
their mean, and eigenvalues and eigenvectors of their scatter matrix. Each partition starts from an empty one and adds its vectors one
after the other: a centred vector is a rank-one update of the scatter matrix, and the eigenvalues of a diagonal matrix plus a rank-one
matrix are the roots of the secular equation between its poles. Where the vector has no share in an eigenvector, or where eigenvalues
are equal (a reflection then puts the whole share into one of them), the eigenpair stays as it is: deflation. The shares are
computed anew from the roots, which keeps eigenvectors of close eigenvalues orthogonal.

Spectra of partitions are combined by successive rank-one updates as well: one for each eigenpair of the smaller one, and one for the
difference of the means. That is done for up to ``FAN`` spectra in a task, round after round, until one is left.

The leading eigenvectors of that spectrum span the first subspace of the refinement. Each round applies the exact covariance to the
subspace in one distributed pass over the rows and solves the small projected problem (Rayleigh-Ritz); while the residuals are above
rounding, the subspace is widened by them. The driver sees a spectrum (d * d numbers) and subspaces, never rows.

Defined results. Rows whose vector is null, empty, or holds a null, non-finite or huge entry (beyond ``LARGEST``) are dropped, and so are
vectors of another length than that of most rows (the longer one, if tied). Repeated rows and null ids count like others; an
empty table gives no rows. ``deviation`` is null where it doesn't fit into 64 bits. A component without variance has the eigenvalue 0
(``explained`` 0) and a null ``whitened``; without any variance ``explained`` is null. ``identity_error`` is taken over the components that have variance,
and is null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.staging import materialize

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0 ** 30
FAN = 16
ROUNDS = 12
RESIDUAL = 1e-13
EPS = np.finfo(float).eps
_BATCH = 4096


# --- rank-one updates

def _secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - x)) = 0`` for ascending poles and positive weights, one above each pole.

    Returned as distances: ``gaps[j, i] = poles[j] - root[i]``, exact to rounding even where a root almost touches a pole, and the roots.
    Every root is sought from its nearer pole, by rational interpolation of both halves of the sum, held in a bracket.
    """
    n = len(poles)
    upper = np.append(poles[1:], poles[-1] + weights.sum() * (1 + 1e-6))  # the last root is at most the sum above its pole
    width = upper - poles
    distance = poles[:, None] - poles[None, :]
    middle = 1 + (weights[:, None] / (distance - width / 2)).sum(axis=0)
    # the last root has no pole above it
    near_upper = (middle < 0) & (np.arange(n) < n - 1)
    origin = np.where(near_upper, upper, poles)
    delta = poles[:, None] - origin[None, :]
    low = np.where(near_upper, -width / 2, np.where(middle < 0, width / 2, 0.0))
    high = np.where(near_upper, 0.0, np.where(middle < 0, width, width / 2))
    left = poles - origin
    right = np.where(near_upper, 0.0, width)
    below = np.arange(n)[:, None] <= np.arange(n)[None, :]
    x = (low + high) / 2
    active = np.arange(n)
    for _ in range(60):
        inverse = 1 / (delta[:, active] - x[active])
        share = weights[:, None] * inverse
        slope = share * inverse
        f = 1 + share.sum(axis=0)
        mask = below[:, active]
        down = np.where(mask, slope, 0.0).sum(axis=0)
        up = slope.sum(axis=0) - down
        now = x[active]
        lo = np.where(f < 0, now, low[active])
        hi = np.where(f < 0, high[active], now)
        low[active], high[active] = lo, hi
        a1, a2 = left[active] - now, right[active] - now
        a = (a1 + a2) * f - a1 * a2 * (down + up)
        b = a1 * a2 * f
        c = f - a1 * down - a2 * up
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = now + step
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        found = np.abs(f) <= 4 * EPS * (1 + np.abs(share).sum(axis=0))
        x[active] = np.where(found, now, new)
        narrow = hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        active = active[~(found | narrow)]
        if not len(active):
            break
    return delta - x, origin + x


def rank_one_update(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``vectors diag(values) vectors^T + u u^T``."""
    z = vectors.T @ u
    norm = float(np.sqrt(z @ z))
    if norm == 0.0:
        return values, vectors
    tolerance = 8 * EPS * max(abs(values[-1]), norm * norm)
    close = np.diff(values) <= tolerance
    if close.any():
        vectors = vectors.copy()
        ends = np.flatnonzero(np.append(~close, True)) + 1
        start = 0
        for end in ends.tolist():
            if end - start > 1:  # equal eigenvalues: reflect their whole share of u into the last of them
                part = z[start:end].copy()
                size = float(np.sqrt(part @ part))
                if size > 0:
                    mirror = part.copy()
                    mirror[-1] += size if part[-1] >= 0 else -size
                    mirror /= np.sqrt(mirror @ mirror)
                    own = vectors[:, start:end]
                    vectors[:, start:end] = own - 2 * np.outer(own @ mirror, mirror)
                    z[start:end] = 0
                    z[end - 1] = -size if part[-1] >= 0 else size
            start = end
    # no share: the eigenpair stays
    moved = np.flatnonzero(np.abs(z) * norm > tolerance)
    if not len(moved):
        return values, vectors
    poles, share = values[moved], z[moved]
    gaps, roots = _secular_roots(poles, share * share)
    # shares for which the computed roots are exact
    between = poles[:, None] - poles[None, :]
    np.fill_diagonal(between, 1.0)
    ratio = -gaps / np.where(np.eye(len(poles), dtype=bool), 1.0, -between)
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(share)
    mix = exact[:, None] / gaps
    mix /= np.sqrt((mix * mix).sum(axis=0))
    if len(moved) == len(values):
        return roots, vectors @ mix
    values, vectors = values.copy(), vectors.copy()
    values[moved], vectors[:, moved] = roots, vectors[:, moved] @ mix
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean, and eigenpairs of the scatter matrix of some vectors."""

    count: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray) -> None:
        """One more vector: a centred rank-one update."""
        apart = vector - self.mean
        self.values, self.vectors = rank_one_update(self.values, self.vectors, apart * np.sqrt(self.count / (self.count + 1)))
        self.count += 1
        self.mean = self.mean + apart / self.count

    def combine(self, other: Spectrum) -> Spectrum:
        """Of both sets of vectors: rank-one updates by the eigenpairs of the one of fewer vectors and by the difference of the means."""
        if other.count > self.count:
            return other.combine(self)
        if not other.count:
            return self
        values, vectors = self.values, self.vectors
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                values, vectors = rank_one_update(values, vectors, np.sqrt(value) * vector)
        apart, count = other.mean - self.mean, self.count + other.count
        values, vectors = rank_one_update(values, vectors, apart * np.sqrt(self.count * (other.count / count)))
        return Spectrum(count, self.mean + apart * (other.count / count), values, vectors)

    def row(self, part: int) -> dict:
        return {"part": part, "count": self.count, "mean": self.mean.tolist(), "values": self.values.tolist(),
                "vectors": self.vectors.ravel().tolist()}

    @classmethod
    def of(cls, row) -> Spectrum:
        mean, values = np.array(row["mean"], float), np.array(row["values"], float)
        return cls(int(row["count"]), mean, values, np.array(row["vectors"], float).reshape(len(values), len(values)))


_SPECTRUM = "part long, count long, mean array<double>, values array<double>, vectors array<double>"


# --- over the rows

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as a matrix of whole numbers."""
    return np.asarray(column.flatten()).reshape(-1, size).astype(np.int64, copy=False)


def whole_numbers(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``(vec_id, x)`` of the rows that count, stored; ``x`` holds ``floor(1024 * c) + 100000``."""
    c = F.col(vector)
    # NaN is greater than any number in Spark, so it fails the comparison, too
    sound = c.isNotNull() & (F.size(c) > 0) & F.forall(
        c, lambda e: F.coalesce(F.abs(e.cast("double")) <= F.lit(LARGEST), F.lit(False)))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return materialize(vectors.where(sound).select(F.col(vec_id).alias("vec_id"), x.alias("x")), "whole-vectors")


def partial_spectra(rows: DataFrame, size: int) -> DataFrame:
    """A spectrum for each partition of ``rows (x)``."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Spectrum.empty(size)
        for batch in batches:
            for x in _matrix(batch.column("x"), size).astype(float):
                own.add(x)
        if own.count:
            yield pa.RecordBatch.from_pandas(pd.DataFrame([own.row(TaskContext.get().partitionId())]), preserve_index=False)

    return rows.select("x").mapInArrow(fit, _SPECTRUM)


def combined_spectrum(spectra: DataFrame, fan: int = FAN) -> Spectrum:
    """All spectra as one; a task combines at most ``fan`` of them (neighbours by part, the parts being dense numbers)."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        whole = Spectrum.of(rows.iloc[0])
        for k in range(1, len(rows)):
            whole = whole.combine(Spectrum.of(rows.iloc[k]))
        return pd.DataFrame([whole.row(int(rows["part"].iloc[0]) // fan)])

    spectra = materialize(spectra, "spectra")
    while spectra.agg(F.max("part")).first()[0]:
        spectra = materialize(spectra.groupBy(F.call_function("div", F.col("part"), F.lit(fan).cast("long")).alias("group"))
                              .applyInPandas(merge, _SPECTRUM), "spectra")
    return Spectrum.of(spectra.first())  # one row


def _cells(rows: DataFrame, size: int, shape: tuple[int, int], kind: str, work) -> np.ndarray:
    """Sum over all batches of ``work(x)``, a matrix of the given shape.

    Each task gives one row a cell and Spark adds them up, so nothing on the driver grows with the number of tasks.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            for k in range(0, len(x), _BATCH):
                total += work(x[k: k + _BATCH])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "value"])

    spark_kind = "long" if kind == "int64" else "double"
    cells = rows.select("x").mapInArrow(add, f"cell long, value {spark_kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(shape, kind)
    for r in cells.collect():  # the cells of one small matrix
        out[r.cell // shape[1], r.cell % shape[1]] = r.value
    return out


def centred(x: np.ndarray, count: int, whole: np.ndarray) -> np.ndarray:
    """``x - whole / count`` as doubles; the numerator is a whole number while it fits."""
    if count * (float(np.abs(x).max(initial=0)) + float(np.abs(whole).max(initial=0)) / max(count, 1)) < 2.0 ** 62:
        return (x * count - whole) / count
    return np.array([[(int(c) * count - int(s)) / count for c, s in zip(r, whole, strict=True)] for r in x], float).reshape(x.shape)


def rayleigh_ritz(apply_covariance, start: np.ndarray, wanted: int, rounds: int = ROUNDS, tolerance: float = RESIDUAL):
    """The ``wanted`` leading eigenpairs: ``(values, vectors, rounds used)``.

    ``apply_covariance(basis)`` is one pass over the data. The basis is widened by the residuals until these are at most
    ``tolerance`` times the greatest eigenvalue, or don't fall any more.
    """
    basis = np.linalg.qr(start)[0]
    room, best, since, kept = len(basis), np.inf, 0, None
    for used in range(1, rounds + 1):
        image = apply_covariance(basis)
        projected = basis.T @ image
        values, mix = np.linalg.eigh((projected + projected.T) / 2)
        order = np.argsort(values)[::-1]
        values, mix = values[order], mix[:, order]
        vectors, images = basis @ mix, image @ mix
        residuals = images[:, :wanted] - vectors[:, :wanted] * values[:wanted]
        error = float(np.sqrt((residuals ** 2).sum(axis=0)).max())
        if error < best:
            best, kept, since = error, (values[:wanted], vectors[:, :wanted]), 0
        else:
            since += 1
        if error <= tolerance * max(values[0], 0) or since >= 2 or values[0] <= 0:
            break
        # the next basis: what is known, the residuals, and the images, which hold directions that the basis lacks
        keep = vectors[:, : min(2 * wanted, vectors.shape[1])]
        wider = np.column_stack([keep, residuals])
        scale = np.sqrt((wider ** 2).sum(axis=0))
        wider = wider[:, scale > 0] / scale[scale > 0]
        basis = np.linalg.qr(wider)[0][:, :room]
    values, vectors = kept
    square, upper = np.linalg.qr(vectors)
    return np.maximum(values, 0), square * np.sign(np.diag(upper)), used


@dataclass
class Whitening:
    """What the rows are projected with: number, sums, trace of the covariance, leading eigenpairs, and the measured error."""

    count: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None
    rounds: int

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows (one column a component); components without variance are NaN."""
        with np.errstate(all="ignore"):
            scaled = self.vectors / np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return centred(x, self.count, self.sums) @ scaled


def fit_whitening(rows: DataFrame, size: int, components: int = COMPONENTS, partitions: int | None = None) -> Whitening:
    """Fits the stored ``rows (x)``, vectors of ``size`` whole numbers, at least one."""
    sums = _cells(rows, size, (1, size + 1), "int64", lambda x: np.append(x.sum(axis=0), len(x)))[0]
    count, whole = int(sums[-1]), sums[:-1]
    spark = rows.sparkSession

    def summed(shape: tuple[int, int], work) -> np.ndarray:
        return _cells(rows, size, shape, "float64", lambda x: work(centred(x, count, whole)))

    # an update takes a fixed time, so the work is dealt evenly over all cores
    spread = max(partitions or spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    spectrum = combined_spectrum(partial_spectra(rows.select("x").repartition(spread), size))
    wanted = min(components, size)
    order = np.argsort(spectrum.values)[::-1]
    start = spectrum.vectors[:, order[: min(size, 2 * wanted)]]

    def covariance(basis: np.ndarray) -> np.ndarray:
        return summed(basis.shape, lambda c: c.T @ (c @ basis)) / count

    values, vectors, used = rayleigh_ritz(covariance, start, wanted)
    trace = float(summed((1, 1), lambda c: np.square(c).sum())[0, 0]) / count
    values = np.where(values > 64 * EPS * max(trace, 0), values, 0.0)
    out = Whitening(count, whole, trace, values, vectors, None, used)
    live = np.flatnonzero(values > 0)
    if len(live):
        scaled = vectors[:, live] / np.sqrt(values[live])

        def products(c: np.ndarray) -> np.ndarray:
            w = c @ scaled
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = summed((len(live) + 1, len(live)), products) / count
        out.identity_error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(live))).max())
    return out


def _deviations(x: np.ndarray, count: int, whole: np.ndarray) -> list[int | None]:
    """Exact ``sum((count * x - whole) ** 2)`` of every row; None beyond 64 bits."""
    most = float(np.abs(x).max(initial=0)) * count + float(np.abs(whole).max(initial=0))
    if most < 2.0 ** 62:
        apart = x * count - whole
        # an upper bound in doubles tells which rows are safe in 64 bits
        safe = np.square(apart.astype(float)).sum(axis=1) < 2.0 ** 62
        exact: list[int | None] = (apart * np.where(safe, 1, 0)[:, None] * apart).sum(axis=1).tolist()
        unsafe = np.flatnonzero(~safe).tolist()
    else:
        exact, unsafe = [None] * len(x), range(len(x))
    for k in unsafe:
        total = sum((int(c) * count - int(s)) ** 2 for c, s in zip(x[k], whole, strict=True))
        exact[k] = total if total < 1 << 63 else None
    return exact


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS,
           partitions: int | None = None) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector and component."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = whole_numbers(vectors, vector, vec_id)
    length = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("rows")).orderBy(
        F.desc("rows"), F.desc("size")).first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size = int(length["size"])
    rows = rows.where(F.size("x") == size)
    fitted = fit_whitening(rows, size, components, partitions)
    explained = [v / fitted.trace if fitted.trace > 0 else None for v in fitted.values.tolist()]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _BATCH):
                part = batch.slice(k, _BATCH)
                x = _matrix(part.column("x"), size)
                white, n, wide = fitted.project(x), len(x), len(fitted.values)
                index = pa.array(np.repeat(np.arange(n), wide))
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(index), pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * wide, fitted.count)),
                    pa.array(_deviations(x, fitted.count, fitted.sums), pa.int64()).take(index),
                    pa.array(white.ravel(), from_pandas=True), pa.array(explained * n, pa.float64()),
                    pa.array([fitted.identity_error] * (n * wide), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)

