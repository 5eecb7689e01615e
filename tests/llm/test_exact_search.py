import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavefold.llm import exact_search
from wavefold.llm.exact_search import exact_top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, k, scale=64, every=20):
    usable = [(i, np.array([math.floor(c * scale) for c in v], object)) for i, v, *_ in rows
              if v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for a, (query, x) in enumerate(usable):
        if query is None or query % every:
            continue
        scored = sorted((-int((x * y).sum()), other is None, other) for b, (other, y) in enumerate(usable) if b != a and len(x) == len(y))
        out += [(query, rank, other, -score) for rank, (score, _, other) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def asks():
    return F.col("vec_id") % 20 == 0


def sample(n=700, dim=12, seed=3, scale=1.0):
    rnd = np.random.default_rng(seed)
    base = (rnd.normal(size=(n, dim)) * scale).astype(np.float32)
    base[n // 3:n // 2] = base[7]  # a vector that a sixth of all rows share: its scores tie
    return [(i, v.tolist(), 0) for i, v in enumerate(base)]


@pytest.mark.parametrize("k", [1, 20, 650, 5000])
def test_against_brute_force(make, k):
    rows = sample()
    assert result(exact_top_k(make(rows, SCHEMA), asks(), k=k)) == brute(rows, k)


@pytest.mark.parametrize("scale", [1e-3, 300.0, 1e6])
def test_ranges_of_scores(make, scale):
    """Scores of one value, those that single precision can't add exactly and those that take several passes."""
    rows = sample(300, scale=scale)
    assert result(exact_top_k(make(rows, SCHEMA), asks(), k=20)) == brute(rows, 20)


@pytest.mark.parametrize("dim", [12, 16])
def test_near_copies_in_the_last_bin(make, dim):
    """The k-th score lies in a full bin with other scores close above it: these count once."""
    rnd = np.random.default_rng(dim)
    base = rnd.normal(size=(900, dim)).astype(np.float32)
    base[100:500] = base[7] + rnd.normal(size=(400, dim)).astype(np.float32) * np.float32(0.01)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    assert result(exact_top_k(make(rows, SCHEMA), asks())) == brute(rows, 20)


def test_many_blocks_agree(make, monkeypatch):
    rows = sample(500)
    monkeypatch.setattr(exact_search, "ROWS_LEAST", 16)
    monkeypatch.setattr(exact_search, "ROWS_MOST", 64)
    assert result(exact_top_k(make(rows, SCHEMA), asks())) == brute(rows, 20)


def test_odd_rows(make):
    rows = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (0, [-3.0, 1.0], 1), (20, None, 0), (40, [NAN, 1.0], 0), (60, [INF, 1.0], 0), (80, [None, 1.0], 0),
            (100, [], 0), (3, [], 0), (120, [5.0], 0), (None, [1.0, 2.0], 0), (None, [9.0, 9.0], 0), (7, [1.0, 2.0], None), (140, [-0.0, 0.0], 0)]
    vectors = make(rows, SCHEMA)
    for name in ("row", "asks", "dim", "score", "rank", "bound", "query_id"):
        vectors = vectors.withColumn(name, F.lit(1))
    assert result(exact_top_k(vectors, asks())) == brute(rows, 20)
    assert result(exact_top_k(vectors, asks(), k=2)) == brute(rows, 2)


def test_empty(make):
    assert result(exact_top_k(make([], SCHEMA), asks())) == []
    assert result(exact_top_k(make([(1, [1.0], 0)], SCHEMA), asks())) == []
    assert result(exact_top_k(make([(20, [1.0], 0)], SCHEMA), asks())) == []
    assert result(exact_top_k(make([(None, None, None)], SCHEMA), asks())) == []
