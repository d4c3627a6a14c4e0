"""Whitening against a plain eigendecomposition in numpy."""

import math
import random

import numpy as np
import pytest

from threadloom.llm import whitening

VECTORS = "vec_id long, embedding array<double>, label int, n string, dim string, v string, component string"


def rows(n=400, dim=6, scale=1.0, seed=3):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        base = [rng.gauss(0, 0.2) for _ in range(dim)]
        made.append((i, [scale * (base[j] + 0.5 * base[0] * j) for j in range(dim)], 1, "n", "d", "v", "c"))
    return made


AWKWARD = [
    (901, None, 1, None, None, None, None), (902, [], 1, None, None, None, None), (903, [None] + [1.0] * 5, 1, None, None, None, None),
    (904, [float("nan")] * 6, 1, None, None, None, None), (905, [float("-inf")] * 6, 1, None, None, None, None),
]


def check(found, kept, components=32):
    """found rows against the integer vectors in kept: (id, x) of one length."""
    x = np.array([v for _, v in kept], dtype=object)
    n, dim, k = len(kept), len(kept[0][1]), min(components, len(kept[0][1]))
    sums = x.sum(axis=0)
    numer = n * x - sums
    centred = (numer / n).astype(float)
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    deviations = {}
    for (i, _), row in zip(kept, numer):
        deviations.setdefault(i, []).append(sum(int(c) ** 2 for c in row))
    assert len(found) == n * k and {r.n for r in found} == {n}
    for i, want in deviations.items():
        got = sorted(r.deviation for r in found if r.vec_id == i and r.component == 1)
        assert got == sorted(want)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9
    for c in range(1, k + 1):
        mine = [r for r in found if r.component == c]
        assert all(math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9) for r in mine)
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r.whitened)
    single = [i for i, c in by_row.items() if all(len(v) == 1 for v in c.values())]
    place = {i: j for j, (i, _) in enumerate(kept)}
    white = np.array([[by_row[i][c][0] for c in range(1, k + 1)] for i in single])
    # Components are eigenvectors up to their sign: found again from their own projections.
    basis = np.linalg.lstsq(centred[[place[i] for i in single]], white, rcond=None)[0] * np.sqrt(values[:k])
    assert np.abs(np.linalg.norm(basis, axis=0) - 1).max() < 1e-8
    assert np.abs(cov @ basis - basis * values[:k]).max() < 1e-8 * values[0]


def integers(v, scale=64, shift=1_000_000):
    return [math.floor(scale * c) + shift for c in v]


@pytest.mark.parametrize("parts", [1, 5, 20])
def test_equals_plain_decomposition(spark, parts):
    made = rows() + AWKWARD + [rows()[7], (None, [0.5] * 6, None, None, None, None, None)]
    found = whitening.whiten(spark.createDataFrame(made, VECTORS).repartition(parts))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), [(r[0], integers(r[1])) for r in made if r not in AWKWARD])


def test_fewer_components_than_entries(spark):
    made = rows(300, 8)
    check(whitening.whiten(spark.createDataFrame(made, VECTORS), components=3).collect(), [(r[0], integers(r[1])) for r in made], 3)


def test_lengths_are_fitted_apart(spark):
    long, short = rows(60, 5), [(500 + i, v[1], *v[2:]) for i, v in enumerate(rows(40, 3, seed=9))]
    found = whitening.whiten(spark.createDataFrame(long + short, VECTORS).repartition(3)).collect()
    check([r for r in found if r.vec_id < 500], [(r[0], integers(r[1])) for r in long])
    check([r for r in found if r.vec_id >= 500], [(r[0], integers(r[1])) for r in short])


def test_equal_vectors_and_empty_table(spark):
    found = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], *[None] * 5) for i in range(3)], VECTORS)).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in found] == [(0, None, None, None)] * 6
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0


def test_dependent_entries_have_no_whitened_value(spark):
    made = [(i, [v[1][0], v[1][1], v[1][0]], *v[2:]) for i, v in enumerate(rows(100))]
    found = whitening.whiten(spark.createDataFrame(made, VECTORS)).collect()
    assert all((r.whitened is None) == (r.component == 3) for r in found)
    assert {r.identity_error for r in found}.pop() < 1e-9


def test_large_entries_stay_exact(spark):
    made = [(i, [1e9 * c for c in v[1]], *v[2:]) for i, v in enumerate(rows(50, 4))]
    found = whitening.whiten(spark.createDataFrame(made, VECTORS)).collect()
    x = np.array([integers(r[1]) for r in made], dtype=object)
    want = {i: sum(int(c) ** 2 for c in row) for i, row in enumerate(len(x) * x - x.sum(axis=0))}
    assert {r.vec_id: r.deviation for r in found} == {i: v if v < 2**63 else None for i, v in want.items()}


@pytest.mark.parametrize("k", [1, 2, 3, 30])
def test_secular_roots(k):
    rng = np.random.default_rng(k)
    for _ in range(40):
        poles, weights = np.sort(rng.random(k)), rng.random(k) ** 6 * 10.0 ** rng.integers(-6, 4)
        base, t = whitening.secular_roots(poles, weights)
        want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
        assert np.allclose(poles[base] + t, want, rtol=1e-9, atol=1e-9 * want[-1])


def test_spectra_combine_to_the_whole():
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((500, 10)) @ rng.standard_normal((10, 10)) * 30).astype(np.int64) + 1_000_000
    x[:, 3], x[100:150] = 7, x[0]
    part = [whitening.Spectrum.empty(10).take(x[a:b]) for a, b in ((0, 120), (120, 130), (130, 500))]
    whole = part[0].combined(part[1]).combined(part[2])
    centred = x - x.mean(axis=0)
    assert whole.n == 500 and whole.sums == x.sum(axis=0).tolist()
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - centred.T @ centred).max() < 1e-9 * whole.values.max()
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(10)).max() < 1e-12
