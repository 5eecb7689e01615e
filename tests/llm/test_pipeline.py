import struct

import corpus_pipeline
from helpers import corpus, crowd, sha
from pyspark.sql import functions
from test_byte_bpe import byte_bpe
from test_line_dedup import brute as line_brute
from test_ngram_join import brute as join_brute

from wavefold.llm import registry


def test_stages_against_brute_force(spark, make, tmp_path):
    rows = [r for r in corpus(seed=11, groups=16) + crowd(16)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "encode"]

    def step(name):
        nonlocal docs
        steps[name](spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        return [tuple(r) for r in docs.collect()]

    before = {r[0]: r for r in rows}
    kept = step("quality_rules")
    assert docs.columns == corpus_pipeline.COLUMNS and all(before[r[0]] == r for r in kept)
    assert 0 < len(kept) < len(rows) and min(len(r[1].split()) for r in kept) >= 50

    lines = line_brute([(r[0], r[1]) for r in kept])
    lean = step("line_dedup")
    assert {r[0]: r[1] for r in lean} == {d: v[2] for d, v in lines.items()} and all(r[4] == len(r[1]) for r in lean)

    groups = join_brute([(r[0], r[1]) for r in lean])
    single = step("near_dedup")
    assert {r[0] for r in single} == {v[1] for v in groups.values()} and len(single) < len(lean)

    drawn = step("mix_sources")
    assert set(drawn) == set(single) and len(drawn) >= len(single)

    own = byte_bpe.codec(*byte_bpe.default_vocabulary())
    tokens = step("encode")
    texts = {r[0]: r[1] for r in single}
    assert len(tokens) == len(drawn)
    assert all(struct.pack(f"<{r[3]}I", *r[4]) == own.encode(texts[r[0]]) for r in tokens)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(tokens)


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_rows_that_share_an_id(spark, make):
    copy, other = " ".join(f"w{i}" for i in range(80)), " ".join(f"x{i}" for i in range(80))
    rows = [(1, copy), (5, copy), (5, other), (7, other + " y"), (9, "alone"), (9, "alone"), (None, copy)]
    docs = make([(d, t, "en", "s", len(t)) for d, t in rows])
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, copy), (5, other), (9, "alone")]


def test_ids_are_decoded(spark, make):
    rows = [(1, "a text, é", "en", "s", 9), (2, None, "en", "s", 0), (1, "", "en", "s", 0)]
    got = corpus_pipeline.encode(spark, make(rows), "").collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in got) == sorted((r[0], sha(r[1] or "")) for r in rows)


def test_rows_that_share_only_the_node_stay(spark, make, monkeypatch):
    class Colliding:
        """The node is the language's hash, so different rows share one; the second hash is as it was."""

        def __getattr__(self, name):
            return getattr(functions, name)

        def xxhash64(self, *cols):
            return functions.xxhash64("lang") if isinstance(cols[0], str) else functions.xxhash64(*cols)

    monkeypatch.setattr(corpus_pipeline, "F", Colliding())
    copy, other = " ".join(f"w{i}" for i in range(80)), " ".join(f"x{i}" for i in range(80))
    rows = [(0, copy, "c"), (1, copy, "a"), (2, other, "a"), (2, other, "a"), (3, other, "d")]
    got = corpus_pipeline.near_dedup(spark, make([(d, t, lang, "s", len(t)) for d, t, lang in rows]), "").collect()
    found = sorted((r[0], r[1]) for r in got)
    assert len(found) == len(set(found)) and {(0, copy), (1, copy), (2, other)} <= set(found)
