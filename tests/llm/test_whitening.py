"""Rank-one updates, combined spectra and the whitened rows against a full decomposition."""

import collections
import math

import numpy as np
import pytest

from affinis.llm import whitening
from affinis.llm.whitening import Spectrum, rank_one_update

VECTORS = "vec_id long, embedding array<float>, label int, x int, count long"


def matrices(d, seed):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(200, d)) * np.linspace(1, 30, d) + 100_000
    repeated = base.copy()
    repeated[:70] = base[0]
    yield base
    yield repeated
    yield np.floor(base / 60) * 60  # ties
    yield np.repeat(base[:1], 50, axis=0)  # no variance
    yield base[: max(2, d // 2)]  # fewer vectors than dimensions
    flat = base.copy()
    flat[:, 0] = 5
    yield flat


@pytest.mark.parametrize("d", [1, 2, 7, 32])
def test_updates_and_combined_spectra_give_the_scatter_matrix(d):
    for x in matrices(d, d):
        whole, parts = Spectrum.empty(d), [Spectrum.empty(d) for _ in range(3)]
        for k, row in enumerate(x):
            whole.add(row)
            parts[k % 7 % 3].add(row)
        apart = x - x.mean(axis=0)
        expected = apart.T @ apart
        for s in (whole, parts[0].combine(parts[1]).combine(parts[2]), Spectrum.empty(d).combine(whole)):
            assert s.count == len(x) and np.allclose(s.mean, x.mean(axis=0), rtol=1e-12)
            scale = max(np.abs(expected).max(), 1)
            assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - expected).max() < 1e-9 * scale
            assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-11


def test_deflation_leaves_untouched_pairs():
    values, vectors = np.array([1.0, 1.0, 2.0, 5.0]), np.eye(4)
    new, rotated = rank_one_update(values, vectors, np.array([3.0, 4.0, 0.0, 0.0]))
    assert np.allclose(new, [1, 2, 5, 26]) and np.allclose(np.abs(rotated[:, 1]), [0, 0, 1, 0])
    assert np.allclose(rotated @ np.diag(new) @ rotated.T, np.diag(values) + np.outer([3, 4, 0, 0], [3, 4, 0, 0]))


def brute(rows, components=8):
    kept = [(r[0], [math.floor(1024 * float(np.float32(c))) + 100_000 for c in r[1]]) for r in rows
            if r[1] and all(c is not None and math.isfinite(c) and abs(c) <= whitening.LARGEST for c in r[1])]
    size = max(collections.Counter(len(x) for _, x in kept).items(), key=lambda x: (x[1], x[0]))[0]
    kept = [k for k in kept if len(k[1]) == size]
    x = np.array([k[1] for k in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[(int(c) * n - int(s)) / n for c, s in zip(r, sums, strict=True)] for r in x], float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    deviations = [sum((int(c) * n - int(s)) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return kept, n, deviations, values[order], vectors[:, order], centred, values.sum()


def check(rows, got, components=8):
    kept, n, deviations, values, vectors, centred, trace = brute(rows, components)
    assert len(got) == len(kept) * len(values)
    white = centred @ vectors / np.sqrt(values)
    by_id = {k[0]: i for i, k in enumerate(kept)}
    table = np.zeros((len(kept), len(values)))
    for r in got:
        i = by_id[r.vec_id]
        assert r.n == n and r.deviation == (deviations[i] if deviations[i] < 1 << 63 else None) and r.identity_error <= 1e-9
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-10
        table[i, r.component - 1] = r.whitened
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table * signs - white).max() < 1e-6


def vectors_of(n, d, seed):
    draw = np.random.default_rng(seed)
    mix = draw.normal(size=(d, d))
    return (draw.normal(size=(n, d)) @ mix).round(3).tolist()


def test_whitened_rows_match_a_full_decomposition(spark):
    rows = [(i, v, 0, 1, 2) for i, v in enumerate(vectors_of(400, 12, 1))]
    rows += [(1000 + i, rows[0][1], 0, 1, 2) for i in range(200)]  # a common vector
    bad = [None, [], [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [1e30] * 12, [0.5] * 11]
    rows += [(2000 + i, v, 0, 1, 2) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = whitening.whiten(df, partitions=40)  # more than FAN: combined in two rounds
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check([r for r in rows if r[1] is None or len(r[1]) != 11], got.collect())


def test_large_entries_few_dimensions_and_exact_deviations(spark):
    rows = [(i, [c * 2.0 ** 28 for c in v], 0, 1, 2) for i, v in enumerate(vectors_of(50, 3, 2))]
    rows = [r for r in rows if max(map(abs, r[1])) < 2 ** 30]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert any(r.deviation is None for r in got)  # beyond 64 bits
    check(rows, got)


def test_tables_without_variance_or_rows(spark):
    same = [(i % 3 or None, [1.0, 2.0], 0, 1, 2) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(same, VECTORS)).collect()
    assert len(got) == 18 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(9, 0, None, None, None)}
    line = [(i, [float(i), 0.0, 1.0], 0, 1, 2) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert {(r.component, r.whitened is None, round(r.explained, 9)) for r in got} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    for none in ([], [(1, None, 0, 1, 2)]):
        assert whitening.whiten(spark.createDataFrame(none, VECTORS)).collect() == []
