import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavefold.llm.product_codes import Codebook, product_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """All rows of one length, by comparing every part with every entry."""
    kept = sorted([r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()],
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in kept], np.float64) * scale).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))
    x = np.stack(np.split(x, parts, 1))
    books = x[:, :entries].copy()
    for left in range(rounds, -1, -1):
        apart = ((x[:, :, None] - books[:, None]) ** 2).sum(3)
        code = apart.argmin(2)
        for p in range(parts if left else 0):
            for e in range(books.shape[1]):
                mine = x[p][code[p] == e]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    error = apart.min(2).sum(0)
    totals = {}
    for r, e in zip(kept, error.tolist(), strict=True):
        totals[r[2]] = totals.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    return sorted([(r[0], "".join(f"{c:02x}" for c in code[:, k]), int(error[k]), totals[r[2]], digest) for k, r in enumerate(kept)], key=str)


def result(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def sample(n=500, dim=64, seed=5):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, dim)).astype(np.float32) * 0.2
    base[40:90] = base[3]  # equal entries and, with the repeats, ties
    labels = [None if i % 7 == 0 else 1 if i % 3 else i % 5 for i in range(n)]  # one label holds most rows
    return [(i * 2, v.tolist(), label) for i, (v, label) in enumerate(zip(base, labels, strict=True))]


def test_against_brute_force(make):
    rows = sample()
    assert result(product_codes(make(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("n, dim", [(10, 64), (64, 16), (200, 37), (130, 5)])
def test_few_rows_and_uneven_lengths(make, n, dim):
    rows = sample(n, dim)
    assert result(product_codes(make(rows, SCHEMA))) == brute(rows)


def test_orchard_search_finds_the_nearest_with_ties():
    rnd = np.random.default_rng(1)
    for size, width, most in ((64, 4, 200), (64, 2, 4), (1, 3, 9), (50, 1, 30), (64, 4, 2)):
        book = rnd.integers(-most, most, (size, width))
        x = np.concatenate([rnd.integers(-2 * most, 2 * most, (400, width)), book])
        apart = ((x[:, None] - book[None]) ** 2).sum(2)
        best, far = Codebook(book).nearest(x)
        assert (best == apart.argmin(1)).all() and (far == apart.min(1)).all()


def test_odd_rows(make):
    rows = [(1, [0.5, -0.25], 1), (1, [0.5, -0.25], None), (None, [0.1, 0.2], None), (2, None, 1), (3, [NAN, 1.0], 1), (4, [INF, 0.0], 2),
            (5, [None, 0.0], 2), (0, [-0.001, 0.0], 7)]
    vectors = make(rows, SCHEMA)
    for name in ("code", "error", "label_error", "of_label", "dim", "part"):
        vectors = vectors.withColumn(name, F.lit(1))
    assert result(product_codes(vectors)) == brute(rows)


def test_lengths_have_books_of_their_own(make):
    short, long = sample(80, 16), [(i + 1, v, label) for i, v, label in sample(90, 64)]
    got = {(r[0], r[1], r[2], r[4]) for r in result(product_codes(make(short + long + [(9, [], 3)], SCHEMA)))}
    want = {(r[0], r[1], r[2], r[4]) for r in brute(short) + brute(long)}
    assert want < got and len(got) == len(want) + 1


def test_empty(make):
    assert result(product_codes(make([], SCHEMA))) == []
    assert result(product_codes(make([(1, None, 0)], SCHEMA))) == []
