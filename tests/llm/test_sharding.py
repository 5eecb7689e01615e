import zlib
from collections import Counter

import pytest
from helpers import corpus
from pyspark.sql import functions as F

from wavefold.llm import sharding


def check(rows, got, shards):
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert set(counts) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    expected = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected


@pytest.mark.parametrize("shards", [4, 7])
def test_even_counts_and_whole_groups(make, shards):
    rows = [(i, f"text {i if i % 5 else i // 40}", "", "", 0) for i in range(400)]
    got = sharding.shard_documents(make(rows), shards).collect()
    check([(r[0], r[1]) for r in rows], got, shards)
    texts = dict((r[0], r[1]) for r in rows)
    homes = {}
    for r in got:
        homes.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_a_group_larger_than_a_shard_fills_few_shards(make):
    rows = [(i, "copy" if i % 2 else f"own {i}", "", "", 0) for i in range(800)]
    got = sharding.shard_documents(make(rows), 8).collect()
    check([(r[0], r[1]) for r in rows], got, 8)
    copies = Counter(r["shard"] for r in got if r["doc_id"] % 2)
    assert len(copies) <= 7 and sum(n for _, n in copies.most_common(5)) >= 300  # 400 copies, 100 rows a shard


def placed(spark, units, room, rounds=sharding.MOVING_ROUNDS):
    rows = [(h, 0, c, chunks, n, [{"n": n, "shard": first}], shard) for h, c, chunks, n, first, shard in units]
    kind = ("h1 long, h2 long, chunk long, chunks long, members long, "
            "votes array<struct<n: bigint, shard: int>>, shard int")
    out, left = sharding.propagate(spark.createDataFrame(rows, kind), room, rounds)
    return {(r["h1"], r["chunk"]): r["shard"] for r in out.collect()}, left


def test_a_later_round_moves_a_unit_to_its_neighbours(spark):
    units = [(1, 0, 3, 10, 0, 0), (1, 1, 3, 10, 0, 0), (1, 2, 3, 10, 2, 2)]
    homes, left = placed(spark, units, [10, 0, 0])
    assert set(homes.values()) == {0} and left == [0, 0, 10]
    homes, left = placed(spark, units, [9, 0, 0])  # no room beside its neighbours: it stays
    assert homes[(1, 2)] == 2 and left == [9, 0, 0]


def test_a_unit_without_room_follows_its_neighbours(spark):
    units = [(1, 0, 2, 10, 0, 1), (1, 1, 2, 10, 0, None), (2, 0, 1, 4, 2, None)]
    homes, left = placed(spark, units, [3, 10, 30])
    assert homes == {(1, 0): 1, (1, 1): 1, (2, 0): 2} and left == [3, 0, 26]


def test_all_units_that_fit_are_placed(spark):
    units = [(h, 0, 1, 2, 0, None) for h in range(300)] + [(999, 0, 1, 50, 0, None)]
    homes, left = placed(spark, units, [200, 200, 200, 49])
    assert homes[(999, 0)] is not None or max(left) < 50
    small = [s for (h, _), s in homes.items() if h != 999]
    assert None not in small or max(left) < 2


def test_all_linked_nulls_repeats_and_extra_columns(make):
    rows = corpus(groups=5) + corpus(groups=5)[:3] + [(None, "x", "", "", 0), (None, None, "", "", 0)]
    docs = make(rows).withColumn("shard", F.lit("x")).withColumn("h1", F.lit("x")).withColumn("slot", F.lit("x"))
    check([(r[0], r[1]) for r in rows], sharding.shard_documents(docs, 5).collect(), 5)
    same = [(i, "same", "", "", 0) for i in range(37)]
    check([(r[0], r[1]) for r in same], sharding.shard_documents(make(same), 5).collect(), 5)


def test_empty_and_tiny_tables(make):
    assert sharding.shard_documents(make([]), 4).count() == 0
    check([(1, "a")], sharding.shard_documents(make([(1, "a", "", "", 0)]), 40).collect(), 40)


def test_query_columns(spark, make, tmp_path):
    make(corpus(groups=3)).write.parquet(f"{tmp_path}/documents.parquet")
    out = sharding.op4_sharding(spark, str(tmp_path))
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r["law"], r["grown_shard"]) for r in out.collect()} == {("rows", None)}
