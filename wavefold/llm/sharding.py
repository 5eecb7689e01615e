"""Balanced label propagation: linked documents share shards of even size.

Documents with equal texts are linked.  Every document starts with a shard dealt by its id, and
the documents that must stay together are a unit: a group of equal texts, or, of a group larger than a
quarter of a shard, a part of about that size dealt by id (no unit outgrows a shard; parts start side by side).

Every round joins each unit with where its group's other units are *now* and counts the votes anew:
placed neighbours by their members, and, for a unit without a shard, its own members' first shards.  A
unit asks for the shard with the most votes that has room (any shard with room if none has), a placed one
only if that shard holds more of its neighbours than its own does.  Each shard grants requests up to
its quota; what a unit leaves behind is free in the next round.  Rounds go on while units find a
shard or move; the moves alone, which only bring neighbours closer, end after ``MOVING_ROUNDS``.

Documents without links fill the quotas up, so the counts differ by one at most.  Only units larger than
the room left in every shard (or refused ``STALLED`` times in a row by shards that had room for single units)
are filled in like them, and lose links.

Only DataFrame functions run here.  Votes and requests are map-side sums; the driver sees at most
``shards x BINS`` numbers a round and those of the moving units, of which there are ``4 x shards`` or so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavefold.llm.common import stage

SHARDS = 40
MOVING_ROUNDS = 12
STALLED = 3
UNITS_PER_SHARD = 4
BINS = 321
UNIT = ["h1", "h2", "chunk", "chunks", "members", "votes"]


def _rank_bins(n: int) -> int:
    return max(1024, n // 20_000)


def _numbered(df: DataFrame, within: list[str], bins: int, name: str) -> DataFrame:
    """Gapless number from 0 inside ``within``, by hash bins: counts first, then offsets."""
    binned = df.withColumn("_bin", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(bins)))
    counts = binned.groupBy(*within, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*within, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*within, "_bin").orderBy("h1", "h2", "doc_id")
    ranked = binned.withColumn("_at", F.row_number().over(inside) - 1)
    return (ranked.join(offsets, [*within, "_bin"])
            .withColumn(name, (F.col("_offset") + F.col("_at")).cast("long")).drop("_bin", "_offset", "_at"))


def requests(units: DataFrame, room: list[int], turn: int) -> DataFrame:
    """``units`` with the shard each asks for (``want``, null: none) and the bin its request falls in.

    Bins shrink by a sixteenth of an octave each, from 4 percent of the units to one in a million, so
    whatever room is left there is a bin that fits.
    """
    free = F.array(*[F.lit(int(x)) for x in room])
    at = (units.filter("chunks > 1 AND shard IS NOT NULL").groupBy("h1", "h2", "shard")
          .agg(F.sum("members").alias("n")).groupBy("h1", "h2")
          .agg(F.collect_list(F.struct("n", "shard")).alias("near")))
    known = units.join(at, ["h1", "h2"], "left").withColumn(
        "near", F.transform(F.coalesce("near", F.expr("cast(array() AS array<struct<n: bigint, shard: int>>)")),
                            lambda v: F.struct((v["n"] - F.when(v["shard"] == F.col("shard"), F.col("members")).otherwise(0)).alias("n"),
                                               v["shard"].alias("shard"))))
    seen = known.withColumn("here", F.when(F.col("shard").isNotNull(), F.get(F.transform(
        F.filter("near", lambda v: v["shard"] == F.col("shard")), lambda v: v["n"]), F.lit(0))).otherwise(F.lit(0)))
    ballots = F.when(F.col("shard").isNull(), F.concat("near", "votes")).otherwise(F.col("near"))
    open_votes = F.filter(ballots, lambda v: (v["n"] > F.col("here")) & ~v["shard"].eqNullSafe(F.col("shard"))
                          & (F.get(free, v["shard"]) >= F.col("members")))
    best = F.get(F.sort_array(open_votes, asc=False), F.lit(0))["shard"]
    open_shards = F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda s: F.get(free, s) >= F.col("members"))
    dealt = F.get(open_shards, F.pmod(F.xxhash64("h1", "h2", "chunk", F.lit(turn)), F.greatest(F.size(open_shards), F.lit(1))).cast("int"))
    # Two neighbours would change places for ever: one half of the placed units may ask in a round, the other in the
    # next, and the halves are drawn anew for every two rounds.
    may = F.pmod(F.xxhash64(F.lit(-1 - turn // 2), "h1", "h2", "chunk") + turn, F.lit(2)) == 0
    want = F.when(F.col("shard").isNull(), F.coalesce(best, dealt)).when(may, best)
    drawn = (F.pmod(F.xxhash64(F.lit(turn), "h1", "h2", "chunk"), F.lit(1 << 20)) + 1) / F.lit(float(1 << 20))
    return (seen.withColumn("want", want).withColumn("bin", F.floor(-16 * F.log2(drawn)).cast("int"))
            .select(*UNIT, "shard", "want", "bin"))


def propagate(units: DataFrame, room: list[int], moving_rounds: int = MOVING_ROUNDS) -> tuple[DataFrame, list[int]]:
    """Shards for ``units`` (``UNIT`` and ``shard``) within ``room``, and the room left."""
    room, turn, moves, stalled = list(room), 0, 0, 0
    while True:
        asked = stage(requests(units, room, turn), "shard-requests")
        sums = asked.filter("want IS NOT NULL").groupBy("want", "bin", "shard").agg(F.sum("members").alias("n")).collect()
        demand = [{} for _ in room]
        for row in sums:
            demand[row["want"]][row["bin"]] = demand[row["want"]].get(row["bin"], 0) + row["n"]
        taken, left = [set() for _ in room], list(room)
        for s, per_bin in enumerate(demand):
            for b, n in sorted(per_bin.items(), key=lambda x: (-x[1], x[0])):
                if n <= left[s]:
                    left[s] -= n
                    taken[s].add(b)
        given = [row for row in sums if row["bin"] in taken[row["want"]]]
        for row in given:
            if row["shard"] is not None:
                left[row["shard"]] += row["n"]
        if given:
            grants = F.array(*[F.array(*[F.lit(b) for b in sorted(bins)]).cast("array<int>") for bins in taken])
            yes = F.coalesce(F.array_contains(F.get(grants, F.col("want")), F.col("bin")), F.lit(False))
            units = asked.withColumn("shard", F.when(yes, F.col("want")).otherwise(F.col("shard"))).select(*UNIT, "shard")
        room, turn = left, turn + 1
        if any(row["shard"] is None for row in given):
            stalled = 0
            continue
        stalled += not given
        moves += 1
        waiting = any(row["shard"] is None for row in sums)
        if stalled >= STALLED or (stalled == 2 and not waiting) or (moves >= moving_rounds and not waiting):
            return units, room


def shard_documents(docs: DataFrame, shards: int = SHARDS, moving_rounds: int = MOVING_ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs(doc_id, text)``.

    Counts of two shards differ by one at most; ``slot`` numbers a shard's rows from 0
    without gaps.  Rows with equal, non-null texts are linked.  Null text: size 16,
    checksum 0, no links.  Null and repeated ids are rows like any other.  An empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h1"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(11), "text")).alias("h2")), "shard-rows")
    total = rows.count()
    target = [total // shards + (s < total % shards) for s in range(shards)]
    chunk_size = max(1, total // shards // UNITS_PER_SHARD)

    groups = rows.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = stage(groups.withColumn("chunks", F.ceil(F.col("n") / chunk_size)), "shard-groups")
    linked = rows.join(groups, ["h1", "h2"]).select(
        "h1", "h2", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col("chunks")).alias("chunk"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("own"),
        F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).alias("start"), "chunks")
    # Units of a split group start side by side, as many to a shard as fit.
    linked = linked.withColumn("label", F.when(F.col("chunks") > 1, F.pmod(F.col("start") + F.floor(F.col("chunk") / UNITS_PER_SHARD), F.lit(shards)))
                               .otherwise(F.col("own")).cast("int"))
    votes = linked.groupBy("h1", "h2", "chunk", "chunks", "label").agg(F.count(F.lit(1)).alias("n"))
    units = (votes.groupBy("h1", "h2", "chunk", "chunks")
             .agg(F.sum("n").alias("members"), F.collect_list(F.struct("n", F.col("label").alias("shard"))).alias("votes")))
    units = stage(units.withColumn("shard", F.lit(None).cast("int")), "shard-units")
    homes, room = propagate(units, target, moving_rounds)
    known = rows.join(groups.select("h1", "h2", "chunks"), ["h1", "h2"], "left")
    known = known.withColumn("chunk", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col("chunks")))
    settled = known.join(homes.select("h1", "h2", "chunk", "shard"), ["h1", "h2", "chunk"], "left")
    settled = stage(settled.select(*rows.columns, "shard"), "shard-settled")

    bins = _rank_bins(total)
    ends, filled = [], 0
    for quota in room:
        filled += quota
        ends.append(filled)
    rest = _numbered(settled.filter("shard IS NULL").withColumn("_all", F.lit(0)), ["_all"], bins, "_rank").drop("_all")
    limits = F.array(*[F.lit(int(x)).cast("long") for x in ends])
    rest = rest.withColumn("shard", F.size(F.filter(limits, lambda end: end <= F.col("_rank")))).drop("_rank")
    every = settled.filter("shard IS NOT NULL").unionByName(rest.select(*settled.columns))
    return _numbered(every, ["shard"], bins, "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in 40 shards by balanced label propagation (law ``rows``)."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
