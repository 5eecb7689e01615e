import numpy as np
from helpers import LOWER, WORD, corpus, crowd
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavefold.llm import ngram_join


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(rows):
    sets = {doc: shingles(text) for doc, text in rows}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {doc: (len(s), root(doc)) for doc, s in sets.items()}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_against_brute_force(make):
    rows = corpus(seed=2) + crowd()
    expected = brute([(r[0], r[1]) for r in rows])
    assert len({v[1] for v in expected.values()}) < len(expected) - 30
    assert result(ngram_join.ngram_components(make(rows))) == expected


def test_links_that_the_first_round_cannot_see(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUB_HASHES", 0)
    rows = corpus(seed=5, groups=8) + crowd(12)
    assert result(ngram_join.ngram_components(make(rows))) == brute([(r[0], r[1]) for r in rows])


def test_nulls_repeats_and_clashing_columns(make):
    text = "one two three four five six"
    rows = [(7, text, "", "", 0), (7, "other words here", "", "", 0), (None, text, "", "", 0), (9, text.upper(), "", "", 0),
            (3, None, "", "", 0), (4, "", "", "", 0)]
    docs = make(rows).withColumn("found", F.lit(1)).withColumn("component_id", F.lit("x")).withColumn("n", F.lit(0))
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in ngram_join.ngram_components(docs).collect())
    seven = sorted(x for x in got if x[0] == 7)
    assert [x for x in got if x[0] != 7] == [(-1, 2, -1), (3, 0, 3), (4, 0, 4), (9, 2, 7)] or \
        [x for x in got if x[0] != 7] == [(-1, 2, -1), (3, 0, 3), (4, 0, 4), (9, 2, 9)]
    assert seven == [(7, 1, 7), (7, 2, 7)]


def test_empty_table(make):
    assert ngram_join.ngram_components(make([])).count() == 0


@given(st.sets(st.integers(0, 60), min_size=1), st.lists(st.sets(st.integers(0, 60), min_size=1), min_size=1, max_size=8))
def test_tree_overlap_keeps_every_link(root, others):
    as_bytes = [np.array(sorted(s), ">u8").tobytes() for s in others]
    got = ngram_join.overlaps(np.array(sorted(root), np.uint64), as_bytes, 80, step=3)
    for found, s in zip(got, others, strict=True):
        linked = 100 * len(root & s) >= 80 * len(root | s)
        assert (found >= 0) == linked and (not linked or found == len(root & s))
