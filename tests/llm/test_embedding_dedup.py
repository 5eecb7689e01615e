import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from wavefold.llm import embedding_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def sample(n=600, dim=16, seed=2):
    """Random vectors, near and exact copies, and a chain of neighbours."""
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, dim))
    near = np.repeat(base[:40], 4, 0) + rnd.normal(size=(160, dim)) * 0.12
    crowd = base[50] + rnd.normal(size=(200, dim)) * 0.08
    both = np.concatenate([base, near, crowd, base[:20], base[:20], base[60:61].repeat(150, 0)]).astype(np.float32)
    return [(i * 2, row.tolist(), 0) for i, row in enumerate(both)]


def brute(rows, cosine=0.95):
    ids = [r[0] for r in rows]
    v = np.array([r[1] for r in rows], np.float64)
    v /= np.sqrt((v * v).sum(1))[:, None]
    links = v @ v.T >= cosine
    np.fill_diagonal(links, False)
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in zip(*np.nonzero(links), strict=True):
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    return {i: (int(links[k].sum()), ids[root(k)]) for k, i in enumerate(ids)}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_recall_and_exactness(make):
    rows, expected = sample(), brute(sample())
    for block in (256, 16):
        got = result(embedding_dedup.vector_components(make(rows, SCHEMA), block=block))
        assert all(got[i][0] <= expected[i][0] for i in expected)
        found, there = sum(g[0] for g in got.values()), sum(e[0] for e in expected.values())
        assert there > 10_000 and found >= 0.99 * there
        assert sum(got[i][1] == expected[i][1] for i in expected) >= 0.98 * len(expected)
        assert all(got[i][2] == (got[i][1] == i) for i in got)


def test_all_cells_give_all_links(make):
    rows = sample(200)
    got = result(embedding_dedup.vector_components(make(rows, SCHEMA), target=1.1))  # out of reach: the whole grid is visited
    assert {i: g[:2] for i, g in got.items()} == brute(rows)


def test_unusable_vectors_and_extra_columns(make):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 1), (3, None, 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [None, 1.0], 0), (8, [], 0), (9, [1.0], 0), (10, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (11, [1.0, 0.0], 0), (12, [0.0, 1.0], 0)]
    vectors = make(rows, SCHEMA).withColumn("rep", F.lit(1)).withColumn("cell", F.lit(1)).withColumn("kept", F.lit(1))
    got = result(embedding_dedup.vector_components(vectors))
    assert got.pop(None) == (0, None, True)
    assert got == {1: (2, 1, True), 2: (2, 1, False), 11: (2, 1, False), 12: (0, 12, True), **{i: (0, i, True) for i in range(3, 11)}}


def test_empty_table(make):
    assert embedding_dedup.vector_components(make([], SCHEMA)).count() == 0
    assert result(embedding_dedup.vector_components(make([(1, None, 0)], SCHEMA))) == {1: (0, 1, True)}


def test_visits_are_the_nearest_cells():
    rnd = np.random.default_rng(1)
    index = embedding_dedup.MultiIndex(rnd.normal(size=(300, 8)), 9)
    vectors = rnd.normal(size=(20, 8))
    one, two = (embedding_dedup._distances(vectors[:, a:a + 4], index.books[k]) for k, a in enumerate((0, 4)))
    every = (one[:, :, None] + two[:, None, :]).reshape(20, -1)
    for count in (1, 5, 40, 81):
        got = index.visits(vectors, count)
        want = np.sort(every, 1)[:, :count]
        assert np.allclose(np.take_along_axis(every, got, 1), want)


def test_every_length_is_compared(make):
    """Two lengths of many vectors, one component, and ids shared by different vectors."""
    wide, narrow = sample(150, seed=3), [(i + 1, v, x) for i, v, x in sample(120, dim=6, seed=4)]
    single = [(100_000 + i, [float(x)], 0) for i, x in enumerate([0.5, 2, -1, 7, -3, 0.1])]
    got = result(embedding_dedup.vector_components(make(wide + narrow + single, SCHEMA), target=1.1))
    assert {i: g[:2] for i, g in got.items()} == {**brute(wide), **brute(narrow), **brute(single)}
    assert len(got) == len(wide) + len(narrow) + len(single)


def test_rows_that_share_an_id(make):
    rows = [(1, [1.0, 0.0], 0), (1, None, 0), (1, [float("nan")], 0), (1, [0.0, 1.0, 0.0], 0), (1, [0.0, 1.0], 0),
            (2, [3.0, 0.0], 0), (2, [2.0, 0.0], 0), (0, [0.0, 2.0, 0.0], 0), (3, [0.0, 1.0, 0.1], 0)]
    got = embedding_dedup.vector_components(make(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [
        (0, 2, 0), (1, 0, 1), (1, 0, 1), (1, 0, 1), (1, 2, 0), (1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 2, 0)]


def test_small_groups_weigh_as_much_as_a_crowd(make, monkeypatch):
    """The links of one crowd are nearly all links; pairs far from each other's cells still have to be found."""
    rnd = np.random.default_rng(7)
    base = rnd.normal(size=(400, 8))
    near = base + rnd.normal(size=base.shape) * 0.15
    crowd = rnd.normal(size=8) + rnd.normal(size=(500, 8)) * 0.01
    rows = [(i, row.tolist(), 0) for i, row in enumerate(np.concatenate([base, near, crowd]).astype(np.float32))]
    expected = {i: n for i, (n, _) in brute(rows).items() if i < 800 and n}
    seen = []
    monkeypatch.setattr(embedding_dedup, "FIRST_CELLS", 2, raising=False)  # far too few: the number doubles
    calibrate = embedding_dedup._calibrate
    monkeypatch.setattr(embedding_dedup, "_calibrate", lambda *a: seen.append(dict(a[5])) or calibrate(*a))
    got = result(embedding_dedup.vector_components(make(rows, SCHEMA), block=16))
    assert len(seen) > 1 and all(b[8] == min(2 * a[8], b[8]) for a, b in zip(seen, seen[1:], strict=False))
    assert np.mean([got[i][0] / n for i, n in expected.items()]) >= 0.998


def test_many_visits_need_little_memory():
    index = embedding_dedup.MultiIndex(np.random.default_rng(1).normal(size=(700, 8)), 500)
    tracemalloc.start()
    assert index.visits(np.random.default_rng(2).normal(size=(1024, 8)), 128).shape == (1024, 128)
    assert index.visits(np.random.default_rng(2).normal(size=(1024, 8)), 4096).shape == (1024, 4096)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
