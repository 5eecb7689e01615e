"""Exact top-k search by inner product through distributed histogram selection.

Every query is scored against every other row, block against block.  A scoring pass returns no scores but
a histogram of each query's scores; the sum over all blocks tells in which bin the k-th
value lies, and the next pass counts that bin alone with bins up to 1,024 times finer, until the bin holds one value or few scores
lie at or above it.  A last pass keeps the scores that reach the bin; ties go to the smaller id.

A block sends only the bins from the top down to the one that holds its own k-th score, as a part's k-th score never
exceeds the whole's: at most k bins for a query and block.  Scores that tie on the k-th value could be a third of all rows; a block
sends the k smallest ids among them, which is all that can be returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavefold.llm.common import stage, table
from wavefold.llm.vectors import measured, whole
from wavefold.session import ship_package

K = 20
SCALE = 64
EVERY = 20
BIN_BITS = 10
FEW = 4  # a query is settled once at most FEW * k scores reach its bin
SIDE_VALUES = 1 << 21  # numbers in a block of candidates; a block of queries has an eighth of it
ROWS_MOST, ROWS_LEAST = 32_768, 256
SCORES = 1 << 20  # scores held at once
KEYS = ("dim", "cblock", "qblock")
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def _kind(bound: float) -> type:
    """A number type in which every partial sum of a score is exact."""
    if bound >= 2.0 ** 62:
        raise ValueError("inner products exceed 64 bits")
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2.0 ** 53 else np.int64


def _scored(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[pa.RecordBatch, dict, np.ndarray]]:
    """Queries of a cell, its candidates, and the scores of one against the other (a query's own row scores lowest of all)."""
    key, block = None, None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in KEYS], 1)
        place = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        for a, b in zip(place.tolist(), [*place[1:].tolist(), batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            if key != tuple(keys[a]):
                key, block = tuple(keys[a]), []
            dim = int(keys[a, 0])
            members = int((part.column("side").to_numpy() == 0).sum())  # candidates come before the queries
            if members:
                block.append(part.slice(0, members))
            if members == part.num_rows or not block:
                continue
            if isinstance(block, list):
                rows = pa.Table.from_batches(block).combine_chunks()
                bound = float(rows.column("bound")[0].as_py())
                block = {"row": rows.column("row").to_numpy(), "vec_id": rows.column("vec_id").combine_chunks(),
                         "x": whole(rows.column("embedding").combine_chunks(), dim, scale).astype(_kind(bound)).T}
            step = max(1, SCORES // len(block["row"]))
            for at in range(members, part.num_rows, step):
                asks = part.slice(at, step)
                x = whole(asks.column("embedding"), dim, scale).astype(block["x"].dtype)
                scores = (x @ block["x"]).astype(np.int64)
                scores[asks.column("row").to_numpy()[:, None] == block["row"]] = np.iinfo(np.int64).min
                yield asks, block, scores


def _histograms(sent: DataFrame, k: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = 1 << BIN_BITS
        for asks, _, scores in _scored(batches, scale):
            low, shift, above, within = (asks.column(c).to_numpy()[:, None] for c in ("low", "shift", "above", "within"))
            # Scores above the bin that is divided are counted already, those below are out.
            place = np.where(scores >= low, scores - low, -1) >> shift
            inside = (place >= 0) & (place < within)
            place += np.arange(len(place))[:, None] * bins
            counts = np.bincount(place[inside], minlength=len(place) * bins).reshape(-1, bins)
            higher = np.cumsum(counts[:, ::-1], 1)[:, ::-1] - counts
            query, found = np.nonzero((counts > 0) & (higher < k - above))
            yield pa.RecordBatch.from_arrays(
                [asks.column("row").take(pa.array(query)), pa.array(found), pa.array(counts[query, found])], names=["row", "bin", "n"])

    return sent.mapInArrow(run, "row bigint, bin bigint, n bigint").groupBy("row", "bin").agg(F.sum("n").alias("n"))


def _winners(sent: DataFrame, k: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.iinfo(np.int64).max
        for asks, block, scores in _scored(batches, scale):
            query, found = np.nonzero(scores >= asks.column("low").to_numpy()[:, None])
            ids = block["vec_id"].take(pa.array(found))
            score = scores[query, found]
            order = np.lexsort((ids.fill_null(last).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), -score, query))
            ranked = query[order]
            rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
            order = order[rank < k]
            yield pa.RecordBatch.from_arrays(
                [asks.column("row").take(pa.array(query[order])), asks.column("vec_id").take(pa.array(query[order])),
                 ids.take(pa.array(order)), pa.array(score[order])], names=["row", "query_id", "vec_id", "score"])

    return sent.mapInArrow(run, "row bigint, query_id bigint, vec_id bigint, score bigint")


def _cells(rows: DataFrame, asks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each block of candidates with each block of queries, the candidates first."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one_of = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "row"), F.col(n)).cast("int")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("low", "shift", "above", "within")]
    members = rows.join(sizes, "dim").select("dim", one_of(11, "cblocks").alias("cblock"), every("qblocks").alias("qblock"),
                                             F.lit(0).alias("side"), "row", "vec_id", "embedding", "bound", *nothing)
    seekers = asks.join(sizes, "dim").select("dim", every("cblocks").alias("cblock"), one_of(13, "qblocks").alias("qblock"),
                                             F.lit(1).alias("side"), "row", "vec_id", "embedding", "bound", "low", "shift", "above", "within")
    return members.unionByName(seekers).repartition(*KEYS).sortWithinPartitions(*KEYS, "side")


def _plan(rows: DataFrame, asks: DataFrame, norms: DataFrame) -> DataFrame:
    """Numbers of blocks by vector length: by bytes, and enough of them to keep a small input's cores busy."""
    most = F.greatest(F.lit(ROWS_LEAST), F.least(F.lit(ROWS_MOST), F.floor(F.lit(SIDE_VALUES) / F.greatest("dim", F.lit(1)))))
    busy = 2 * rows.sparkSession.sparkContext.defaultParallelism
    least = F.least(F.lit(busy), F.ceil(F.col("members") / ROWS_LEAST))
    counts = asks.groupBy("dim").agg(F.count(F.lit(1)).alias("queries"))
    return norms.join(counts, "dim").select(
        "dim", "bound", F.greatest(least, F.ceil(F.col("members") / most)).cast("int").alias("cblocks"),
        F.ceil(F.col("queries") * 8 / most).cast("int").alias("qblocks"))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows for each row of ``vectors(vec_id, embedding)`` with ``is_query``.

    A component counts as ``floor(scale * component)``, a score is the integer inner product of two vectors, equal scores go to the
    smaller ``vec_id`` (null last).  A row is no candidate for itself; another row with its id or its vector is.  Query
    rows that share an id have ``k`` results each; a null id asks nothing.  Vectors that are null or hold null or non-finite components take
    no part; a vector meets those of its length only (empty ones score 0).  With fewer than ``k`` candidates all are returned; an
    empty table gives no rows.  Other columns are not read.  Components times ``scale`` from 2^53 and scores from 2^62 are errors.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    asked = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stage(measured(asked, "vec_id", "asks").withColumn("row", F.monotonically_increasing_id()), "search-rows")
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x.cast("double") * scale), F.lit(2)))
    # No score and no partial sum of one exceeds the square of the longest vector.
    norms = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("members"), F.ceil(F.max(square) + 1).cast("double").alias("bound"))
    queries = rows.filter("asks")
    sizes = stage(_plan(rows, queries, norms), "search-blocks")
    span = F.ceil(F.log2(F.col("bound") * 2 + 2)).cast("long")
    state = stage(queries.join(sizes.select("dim", "bound"), "dim").select(
        "dim", "row", "vec_id", "embedding", (-F.col("bound")).cast("long").alias("low"),
        F.greatest(F.lit(0), span - BIN_BITS).cast("long").alias("shift"), F.lit(0).cast("long").alias("above"),
        F.lit(1 << BIN_BITS).cast("long").alias("within"), F.lit(False).alias("settled")), "search-state")
    while not (unsettled := state.filter("NOT settled")).isEmpty():
        found = _histograms(_cells(rows, unsettled, sizes), k, scale)
        down = Window.partitionBy("row").orderBy(F.desc("bin"))
        reached = (found.withColumn("run", F.sum("n").over(down)).join(unsettled.select("row", "above"), "row")
                   .filter("run + above >= %d" % k)
                   .groupBy("row").agg(F.max(F.struct("bin", "run", "n")).alias("at")))
        # Without such a bin there are fewer than k candidates: all of them count.
        none = F.col("at").isNull()
        low = F.when(none, F.col("low")).otherwise(F.expr("low + at.bin * CAST(pow(2, shift) AS BIGINT)"))
        settled = none | (F.col("shift") == 0) | (F.col("above") + F.col("at.run") <= FEW * k)
        finer = F.least("shift", F.lit(BIN_BITS))  # a bin of 2^shift scores has no more than that many bins
        after = unsettled.join(reached, "row", "left").select(
            "dim", "row", "vec_id", "embedding", low.alias("low"), (F.col("shift") - finer).cast("long").alias("shift"),
            F.coalesce(F.col("above") + F.col("at.run") - F.col("at.n"), "above").alias("above"),
            F.pow(F.lit(2), finer).cast("long").alias("within"), settled.alias("settled"))
        state = stage(state.filter("settled").unionByName(after), "search-state")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (_winners(_cells(rows, state, sizes), k, scale).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op11_exact_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best other rows for each ``embeddings`` row whose ``vec_id`` is divisible by 20."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON len(q.x) = len(c.x) AND q.r <> c.r WHERE q.vec_id % {EVERY} = 0),
t AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= {K}
"""
