import random

import pytest
from helpers import WORD, corpus, crowd, sha
from pyspark.sql import functions as F

from wavefold.llm import substring_dedup


def brute(rows, window):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i:i + window])
            if run in seen:
                gone[i:i + window] = [True] * window
            seen.add(run)
        out[doc] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def result(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()}


def test_against_brute_force(make):
    rows = corpus(seed=7) + crowd(20) + [(5000, "same " * 90, "", "", 0), (5001, "a b c " * 40, "", "", 0)]
    expected = brute([(r[0], r[1]) for r in rows], 20)
    assert sum(v[1] > 0 for v in expected.values()) > 20
    assert result(substring_dedup.substring_dedup(make(rows))) == expected
    digests = result(substring_dedup.substring_dedup(make(rows), digest=True))
    assert digests == {d: (n, g, sha(t)) for d, (n, g, t) in expected.items()}


def test_other_sizes_and_white_space(make):
    rnd = random.Random(3)
    pieces = [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 9))) for _ in range(20)]
    rows = [(i, rnd.choice(["\t", "\x0b", "\n ", "\xa0", " "]).join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9))), "", "", 0) for i in range(80)]
    for window, block in ((5, 3), (7, 2)):
        assert result(substring_dedup.substring_dedup(make(rows), window, block)) == brute([(r[0], r[1]) for r in rows], window)
    with pytest.raises(ValueError):
        substring_dedup.substring_dedup(make(rows), 20, 11)


def test_repeats_null_ids_and_extra_columns(make):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "", "", 0), (2, "x " + text, "", "", 0), (2, "other", "", "", 0), (None, text, "", "", 0)]
    docs = make(rows).withColumn("found", F.lit(1)).withColumn("kept", F.lit(1)).withColumn("part", F.lit(1))
    got = sorted((r["doc_id"] or -1, r["n_removed"], r["kept"]) for r in substring_dedup.substring_dedup(docs).collect())
    assert got[:2] == [(-1, 0, text), (1, 0, text)]
    assert sorted(got[2:]) in ([(2, 0, "other"), (2, 30, "x")], [(2, 0, "other"), (2, 0, "x " + text)])


def test_empty_table(make):
    assert substring_dedup.substring_dedup(make([])).count() == 0


def test_more_rows_than_a_slice(make):
    """Rows far into a batch, with and without hits."""
    rnd = random.Random(3)
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(25)) + (" " + shared if i % 3 == 0 else ""), "en", "s", 0) for i in range(2600)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(make(rows, parts=1)).collect()}
    assert got == {r[0]: (55, 30 if r[0] else 0) if r[0] % 3 == 0 else (25, 0) for r in rows}
