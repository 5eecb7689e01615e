import base64
import struct

import pytest
from helpers import corpus, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavefold.llm import byte_bpe

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    path = tokenizers.path(byte_bpe.VOCABULARY)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: struct.pack(f"<{len(ids := own.encode_ordinary(text))}I", *ids)


@pytest.fixture(scope="module")
def own():
    return byte_bpe.codec(*byte_bpe.default_vocabulary())


ODD = st.sampled_from([" ", "  ", "\n", " \n ", "\t", "\x1c", "\x85", "\xa0", " ", "　", "'s", "'LL", " the", "é", "ß", "中", "😀", "́", "٣", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(ODD, st.text(max_size=6)), max_size=30).map("".join))
def test_any_text(reference, own, text):
    ids = own.encode(text)
    assert ids == reference(text) and own.decode(ids) == text.encode()


def test_long_runs(reference, own):
    for text in ("a" * 3000, " " * 3000, "ab " * 3000, "\n" * 999 + " x" * 50, "word." * 2000):
        assert own.encode(text) == reference(text)


def test_cache_limit_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    small = byte_bpe.Codec(*byte_bpe.default_vocabulary())
    for text in ("one two three four five", "six seven eight one", "", "one two nine ten eleven twelve"):
        assert small.encode(text) == reference(text)


def test_documents(make, reference):
    rows = corpus(groups=4)
    docs = make(rows).withColumn("n_tokens", F.lit("old")).withColumn("token_ids", F.lit("old")).withColumn("more", F.lit(1))
    out = byte_bpe.encode_documents(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "more", "token_ids", "n_tokens"]
    for r in out.collect():
        assert struct.pack(f"<{r['n_tokens']}I", *r["token_ids"]) == reference(r["text"] or "")
    one = byte_bpe.encode_documents(docs, decoded=True)
    assert sorted(map(tuple, one.select("doc_id", "decoded_sha256").collect())) == sorted(
        map(tuple, byte_bpe.decode_documents(out).select("doc_id", "decoded_sha256").collect())) == sorted((r[0], sha(r[1] or "")) for r in rows)
    digests = {r["doc_id"]: tuple(r)[1:] for r in byte_bpe.token_digests(docs).collect()}
    assert digests == {r[0]: (len(ids := reference(r[1] or "")) // 4, sha(ids), sha(r[1] or "")) for r in rows}
    assert byte_bpe.token_digests(make([])).count() == 0 == byte_bpe.encode_documents(make([])).count()
