from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavefold.llm.whitening import polar, spectral_components, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, count=4, scale=256):
    """``vec_id, deviation`` and whitened matrix, values and trace of the rows of one length, by numpy's solver."""
    kept = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    x = np.floor(np.array([r[1] for r in kept], np.float64) * scale).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [r[0] for r in kept], n, deviation, (x - sums / n) @ vectors / np.sqrt(values), values / np.trace(cov)


def check(rows, got):
    ids, n, deviation, whitened, explained = brute(rows)
    count = whitened.shape[1]
    assert len(got) == len(ids) * count and {r["n"] for r in got} == {n}
    assert sorted((r["vec_id"], r["component"], r["deviation"]) for r in got) == sorted(
        (i, c + 1, d) for i, d in zip(ids, deviation, strict=True) for c in range(count))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for c in range(count):
        mine = {r["vec_id"]: r for r in got if r["component"] == c + 1}
        one = np.array([mine[i]["whitened"] for i in ids])
        sign = np.sign((one * whitened[:, c]).sum())
        assert np.abs(one - sign * whitened[:, c]).max() < 1e-8
        assert abs(mine[ids[0]]["explained"] / explained[c] - 1) < 1e-9


def sample(n=400, dim=24, seed=6):
    rnd = np.random.default_rng(seed)
    base = (rnd.normal(size=(n, dim)) * np.linspace(0.6, 0.05, dim) @ np.linalg.qr(rnd.normal(size=(dim, dim)))[0] + 0.3).astype(np.float32)
    base[100:250] = base[9]  # copies count once in the fit
    return [(i * 3, v.tolist(), 0) for i, v in enumerate(base)]


def test_against_brute_force(make):
    rows = sample()
    check(rows, whiten(make(rows, SCHEMA)).collect())


def test_far_from_zero(make):
    """A mean a thousand times the spread: nothing may cancel."""
    rows = [(i, [float(np.float32(v + 3000.0)) for v in x], 0) for i, x, _ in sample(200, 6)]
    check(rows, whiten(make(rows, SCHEMA)).collect())


def test_deviation_is_exact_or_null(make):
    rows = [(1, [float(2 ** 40)], 0), (2, [0.0], 0), (3, [1.0], 0)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(make(rows, SCHEMA), scale=1).collect()}
    total = 2 ** 40 + 1
    want = {i: (3 * int(v[0]) - total) ** 2 for i, v, _ in rows}
    assert got == {i: d if d < 2 ** 63 else None for i, d in want.items()}
    assert Fraction(want[3]) > 0


def test_odd_rows(make):
    rows = [(1, [0.5, -0.25], 1), (2, [0.0, 1.0], 0), (3, [1.0, 0.25], 0), (4, [0.25, 0.125], 0)]
    odd = [(5, None, 1), (6, [NAN, 1.0], 1), (7, [INF, 0.0], 2), (8, [None, 0.0], 2), (9, [], 0)]
    vectors = make(rows + odd, SCHEMA)
    for name in ("x", "n", "dim", "component", "whitened", "i"):
        vectors = vectors.withColumn(name, F.lit(1))
    check(rows, whiten(vectors).collect())
    twice = whiten(make(rows + [(1, [0.5, -0.25], 1), (None, [0.5, -0.25], 0)], SCHEMA)).collect()
    assert len(twice) == 12 and {r["n"] for r in twice} == {4}
    assert len({(r["whitened"], r["deviation"]) for r in twice if r["vec_id"] in (1, None) and r["component"] == 1}) == 1


def test_no_variance(make):
    flat = [tuple(r)[1:] for r in whiten(make([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], SCHEMA)).collect()]
    assert sorted(flat) == [(1, 1, 0, None, None, None)] * 2 + [(2, 1, 0, None, None, None)] * 2
    line = whiten(make([(1, [0.5, 1.0], 0), (2, [1.0, 2.0], 0), (3, [0.25, 0.5], 0)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line) and line[0]["identity_error"] < 1e-9


def test_lengths_have_fits_of_their_own(make):
    short, long = sample(60, 5), [(i + 1, v, 0) for i, v, _ in sample(70, 9)]
    got = whiten(make(short + long, SCHEMA)).collect()
    ids = {r[0] for r in short}
    check(short, [r for r in got if r["vec_id"] in ids])
    check(long, [r for r in got if r["vec_id"] not in ids])


def test_empty(make):
    assert whiten(make([], SCHEMA)).collect() == []
    assert whiten(make([(1, None, 0)], SCHEMA)).collect() == []


@pytest.mark.parametrize("values", [[3.0, 2.0, 1.0], [4.0] * 3 + [2.0] * 2 + [1e-9, 0.0], [1.0] * 5, [0.0] * 4, [2.0], list(np.geomspace(1, 1e-12, 40))])
def test_divide_and_conquer(values):
    size = len(values)
    q = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
    for a in (np.diag(values), q @ np.diag(values) @ q.T):
        a = (a + a.T) / 2
        for count in (None, 2):
            found, vectors = spectral_components(a, count)
            assert np.abs(found - np.array(values)[:count]).max() < 1e-13 * size * values[0] + 1e-300
            assert np.linalg.norm(a @ vectors - vectors * found) < 1e-13 * size * values[0] + 1e-300
            assert np.linalg.norm(vectors.T @ vectors - np.eye(len(found))) < 1e-12


def test_polar_factor_is_the_sign():
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(30, 30)))[0]
    values = np.concatenate([np.geomspace(1e-10, 1, 15), -np.geomspace(1e-8, 2, 15)])
    a = q @ np.diag(values) @ q.T
    sign = polar((a + a.T) / 2)
    assert np.linalg.norm(sign @ sign - np.eye(30)) < 1e-12
    assert round(np.trace(sign)) == 0
