"""Temperature mixing of sources under a repetition limit or to a target entropy.

A source's weight is its token share raised to an exponent between 0 (equal weights) and
1 (natural shares).  The exponent is found by bisection: the smallest that
keeps every source within ``max_repeats`` passes, or the one whose weights have a wanted entropy.  The
budget is the smallest that uses every document: the most plentiful source
is passed over once, the others as often as their weights ask.

Budgets become block permutations.  Each pass orders a source's documents by a hash of pass
and id; the leading bits of the hash are blocks.  Whole passes take all blocks; the last,
partial pass takes blocks in order until its budget is spent and cuts the block that crosses
it at a document.  So a document's membership depends on its source and its own
hash alone, and texts are never shuffled.

Only DataFrame functions run here; the driver sees sums, never sources or documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavefold.llm.common import stage, unused

MAX_REPEATS = 2.0
BLOCK_DOCS = 512
SEED = 17
_GRID = 32


def _word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _permuted(epoch):
    """The hash that orders documents in a pass, made non-negative."""
    return F.xxhash64(F.lit(SEED), epoch, "doc_id").bitwiseAND(F.lit((1 << 63) - 1))


def _narrowed(sources: DataFrame, measure, wanted: float, rising: bool) -> float:
    """Exponent in [0, 1] where ``measure(exponent)`` meets ``wanted``: three rounds of 32 sections each.

    ``rising``: the measure grows with the exponent.  Each round is one aggregation over the sources.
    """
    low, high = 0.0, 1.0
    for _ in range(3):
        points = [low + (high - low) * i / _GRID for i in range(_GRID + 1)]
        row = sources.agg(*[measure(x).alias(f"x{i}") for i, x in enumerate(points)]).first()
        meets = [row[i] is None or (row[i] >= wanted if rising else row[i] <= wanted) for i in range(_GRID + 1)]
        first = meets.index(True) if True in meets else _GRID
        low, high = points[max(0, first - 1)], points[first]
    return high


def weights(docs: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None) -> DataFrame:
    """``source, n_docs, n_tokens, weight, repeats`` from ``docs(source, n_tokens)``.

    With ``entropy`` (natural logarithm) the exponent is the largest whose weights reach it, or 0 if none
    does, else the smallest that keeps ``repeats <= max_repeats``.  A source without tokens has weight 0 and one pass.
    """
    totals = stage(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")), "mix-sources")
    span = totals.agg(F.max("n_tokens").alias("most")).first()
    most = float(span["most"] or 1) or 1.0
    share = F.col("n_tokens") / F.lit(most)
    full = totals.filter("n_tokens > 0")
    if entropy is None:
        exponent = _narrowed(full, lambda x: F.max(F.pow(share, F.lit(x - 1))), max_repeats, rising=False)
    else:
        def of_weights(x):
            power = F.pow(share, F.lit(x))
            return -(F.log(F.sum(power)) - F.sum(power * F.log(power)) / F.sum(power))
        # The entropy falls as the exponent grows: search from the flat end.
        exponent = _narrowed(full, lambda x: of_weights(1 - x) * -1, entropy, rising=True)
        exponent = 1 - exponent
    power = F.when(F.col("n_tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(0.0)
    total = totals.agg(F.sum(power)).first()[0] or 1.0
    return totals.withColumn("weight", power / F.lit(total)).withColumn(
        "repeats", F.when(F.col("n_tokens") > 0, F.pow(share, F.lit(exponent - 1))).otherwise(1.0))


def passes(docs: DataFrame, weighted: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``source, whole, bits, last_key``: whole passes, block bits, and the last hash taken in the partial pass (-1: none).

    ``docs`` has ``doc_id, source, n_tokens``.
    """
    plan = weighted.select(
        "source", "weight", "repeats", F.floor("repeats").cast("int").alias("whole"),
        ((F.col("repeats") - F.floor("repeats")) * F.col("n_tokens")).alias("budget"),
        F.least(F.lit(40), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n_docs") / F.lit(block_docs))))).cast("int").alias("bits"))
    plan = stage(plan, "mix-plan")
    partial = docs.join(plan.filter("budget >= 1"), "source")
    keyed = partial.select("source", "doc_id", "n_tokens", "budget", "bits", _permuted(F.col("whole")).alias("key"))
    keyed = keyed.withColumn("block", F.expr("shiftright(key, 63 - bits)"))
    blocks = stage(keyed.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"), F.first("budget").alias("budget")), "mix-blocks")
    # Running sums in two levels: groups of 1,024 blocks, then blocks of a group.
    grouped = blocks.withColumn("high", F.expr("shiftright(block, 10)"))
    sums = grouped.groupBy("source", "high").agg(F.sum("tokens").alias("tokens"))
    over = Window.partitionBy("source").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("source", "high", F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "high").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.join(ahead, ["source", "high"]).withColumn(
        "ahead", F.col("ahead") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    # The last block that still begins within the budget is the one that crosses it.
    crossing = stage(placed.filter(F.col("ahead") < F.col("budget")).groupBy("source")
                     .agg(F.max(F.struct("block", "ahead")).alias("last"))
                     .select("source", F.col("last.block").alias("block"), F.col("last.ahead").alias("ahead")), "mix-crossing")
    order = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = (keyed.join(crossing, ["source", "block"])
           .withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
           .filter(F.col("ahead") < F.col("budget")).groupBy("source").agg(F.max("key").alias("last_key")))
    return stage(plan.join(cut, "source", "left").select(
        "source", "weight", "repeats", "whole", "bits", F.coalesce("last_key", F.lit(-1)).alias("last_key")), "mix-passes")


def mixed(docs: DataFrame, max_repeats: float = MAX_REPEATS, entropy: float | None = None) -> DataFrame:
    """``docs`` with a row for each time a document is used, plus ``epoch``, ``block`` and ``order_key``.

    Needs ``doc_id, source, text``; tokens are words.  Every document is used at least once;
    the partial pass overshoots its budget by less than one document.  A null source is a source of its own; a
    null or wordless text weighs nothing and is used once per whole pass.  Rows that repeat are
    separate documents of one hash.  Existing columns of the three names are replaced; all others stay.
    """
    base = docs.drop("epoch", "block", "order_key")
    named = F.coalesce("source", F.lit(""))
    counted = stage(base.select("doc_id", named.alias("source"), _word_count(F.col("text")).alias("n_tokens")), "mix-counts")
    plan = passes(counted, weights(counted, max_repeats, entropy))
    own, whole, bits, last = unused(base, "_source", "_whole", "_bits", "_last")
    plan = plan.select(F.col("source").alias(own), F.col("whole").alias(whole), F.col("bits").alias(bits), F.col("last_key").alias(last))
    joined = base.join(plan, named == F.col(own))
    again = _permuted(F.col(whole)) <= F.col(last)
    uses = F.sequence(F.lit(0), F.when(again, F.col(whole)).otherwise(F.col(whole) - 1))
    return (joined.withColumn("epoch", F.explode(uses)).withColumn("order_key", _permuted(F.col("epoch")))
            .withColumn("block", F.expr(f"shiftright(order_key, 63 - `{bits}`)"))
            .select(*base.columns, "epoch", "block", "order_key"))


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mixture drawn from all of ``documents``: a row per use, with its place in the block permutation."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "source", "text")
    rows = mixed(docs).select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "epoch", "block", "order_key",
                              _word_count(F.col("text")).alias("n_tokens"))
    slot = Window.partitionBy("source", "epoch", "block").orderBy("order_key", "doc_id")
    return rows.withColumn("slot", (F.row_number().over(slot) - 1).cast("long")).drop("order_key")
