import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus, crowd, sha
from pyspark.sql import functions as F

from wavefold.llm import suffix_dedup


def brute(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(raw[i:i + length])
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[doc] = (len(raw), int(gone.sum()), int((edge == 1).sum()), sha(bytes(b for b, g in zip(raw, gone, strict=False) if not g)))
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]).decode()) for r in df.collect()}


@pytest.mark.parametrize("limit", [50_000, 3])
def test_against_brute_force(make, limit):
    rows = corpus(seed=6) + crowd(20)
    rows += [(5000, "ab" * 300, "", "", 0), (5001, "c" * 99, "", "", 0), (5002, "c" * 100, "", "", 0), (5003, "é" * 200, "", "", 0)]
    expected = brute([(r[0], r[1]) for r in rows], 100)
    assert sum(v[2] for v in expected.values()) > 20
    assert result(suffix_dedup.suffix_dedup(make(rows), digest=True, group_limit=limit)) == expected


def test_shifted_overlaps_and_other_lengths(make):
    rnd = random.Random(8)
    pieces = ["".join(rnd.choice("abc \n") for _ in range(rnd.randint(3, 25))) for _ in range(12)]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))), "", "", 0) for i in range(60)]
    for length, gram in ((20, 6), (12, 2)):
        got = result(suffix_dedup.suffix_dedup(make(rows), length, gram, digest=True))
        assert got == brute([(r[0], r[1]) for r in rows], length)


def test_kept_bytes_repeats_null_ids_and_extra_columns(make):
    text = "".join(chr(97 + i % 23) + str(i) for i in range(90))
    rows = [(1, text, "", "", 0), (2, "x" + text, "", "", 0), (2, "other", "", "", 0), (None, text, "", "", 0)]
    docs = make(rows).withColumn("found", F.lit(1)).withColumn("kept", F.lit(1)).withColumn("spans", F.lit(1))
    got = sorted((r["doc_id"] or -1, r["n_removed"], bytes(r["kept"])) for r in suffix_dedup.suffix_dedup(docs).collect())
    n = len(text)
    assert got[0] == (-1, 0, text.encode()) and got[1] == (1, 0, text.encode())
    assert sorted(got[2:]) in ([(2, 0, b"other"), (2, n, b"x")], [(2, 0, b"other"), (2, 0, b"x" + text.encode())])


def test_empty_table(make):
    assert suffix_dedup.suffix_dedup(make([])).count() == 0


def test_rejects_grams_that_leave_windows_without_anchor(make):
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(make([]), 100, 60)


def test_anchors_spread_over_parts():
    """Anchors are small hashes: their parts must not follow that."""
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abcdefghij klmnop") for _ in range(4000)) for _ in range(300)]
    _, _, keys, _ = suffix_dedup.anchors(pa.array(texts), suffix_dedup.LENGTH, suffix_dedup.GRAM)
    for parts in (7, 51, 400):
        sizes = np.bincount(suffix_dedup.anchor_part(keys, parts).astype(np.int64), minlength=parts)
        assert sizes.max() < 3 * sizes.mean() and sizes.min() > 0
