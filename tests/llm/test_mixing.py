import math

import pytest
from helpers import WORD
from pyspark.sql import functions as F

from wavefold.llm import mixing

SIZES = {"big": 900, "mid": 300, "small": 90, None: 30}


def rows():
    out = []
    for k, (source, n) in enumerate(SIZES.items()):
        out += [(k * 10_000 + i, "word " * (1 + i % 4), "en", source, 0) for i in range(n)]
    return out


def used(df):
    return [(r["source"] or "", r["doc_id"], r["epoch"], len(WORD.findall(r["text"] or ""))) for r in df.collect()]


def test_repetition_limit_budget_and_blocks(make):
    got = used(mixing.mixed(make(rows()), max_repeats=3.0))
    natural = {s or "": sum(1 + i % 4 for i in range(n)) for s, n in SIZES.items()}
    drawn = dict.fromkeys(natural, 0)
    for source, _, _, n in got:
        drawn[source] += n
    repeats = {s: drawn[s] / natural[s] for s in natural}
    assert repeats["big"] == 1 and 2.9 < repeats[""] <= 3.0 + 4 / natural[""]
    # Weights are one power of the shares: repeats = share ** (exponent - 1) up to one document of each source.
    exponent = 1 + math.log(repeats[""]) / math.log(natural[""] / natural["big"])
    for s in ("mid", "small"):
        assert abs(drawn[s] - natural[s] * (natural[s] / natural["big"]) ** (exponent - 1)) <= 12
    whole = {(s, e) for s, _, e, _ in got}
    for source, epoch in whole:
        own = [d for s, d, e, _ in got if (s, e) == (source, epoch)]
        assert len(own) == len(set(own))
    assert {d for _, d, _, _ in got} == {r[0] for r in rows()}


def test_entropy_target(make):
    counted = make(rows()).select(F.coalesce("source", F.lit("")).alias("source"), F.lit(1).alias("n_tokens"))
    for target in (0.95, 1.2):
        found = mixing.weights(counted, entropy=target).collect()
        assert abs(-sum(r["weight"] * math.log(r["weight"]) for r in found) - target) < 1e-3
    flat = mixing.weights(counted, entropy=5.0).collect()
    assert max(r["weight"] for r in flat) == pytest.approx(0.25)


def test_partial_pass_cuts_inside_a_block(make):
    got = used(mixing.mixed(make(rows()), max_repeats=1.5))
    last = [n for s, _, e, n in got if s == "" and e == 1]
    total = sum(1 + i % 4 for i in range(30))
    assert total * 0.5 - 0.5 <= sum(last) <= total * 0.5 + 4


def test_is_reproducible_and_keeps_other_columns(make):
    docs = make(rows()).withColumn("_source", F.lit("own")).withColumn("_last", F.lit(1)).withColumn("epoch", F.lit("old"))
    first, again = (mixing.mixed(d) for d in (docs, docs.repartition(7)))
    assert first.columns == [*docs.drop("epoch").columns, "epoch", "block", "order_key"]
    assert sorted(used(first)) == sorted(used(again))
    assert {r["_source"] for r in first.collect()} == {"own"}


def test_nulls_and_empty_table(make):
    got = used(mixing.mixed(make([(1, None, None, "a", None), (2, "", None, "b", 0), (None, "x y", None, None, 1), (3, "z", None, "a", 1)])))
    assert {(s, d) for s, d, _, _ in got} == {("a", 1), ("b", 2), ("", None), ("a", 3)}
    assert mixing.mixed(make([])).count() == 0


def test_query_numbers_every_block(spark, make, tmp_path):
    make(rows()).write.parquet(f"{tmp_path}/documents.parquet")
    places = {}
    for r in mixing.op3_source_mixing(spark, str(tmp_path)).collect():
        places.setdefault((r["source"], r["epoch"], r["block"]), []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values()) and len(places) > 6
