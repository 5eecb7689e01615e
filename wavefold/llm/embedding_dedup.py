"""Near-duplicate vectors through an inverted multi-index.

Two codebooks, one for each half of the vector, are fitted on a bounded sample; their
product is a grid of cells and every vector has a home cell.  A query visits cells in
the order of the summed distances to the two halves' centroids.  Vectors of different lengths have grids of their own.  How many is measured: ``PROBE_SAMPLE`` vectors
are compared with all by brute force, and the number of cells is the smallest that finds ``TARGET`` of a vector's
links on average over the sampled vectors that have links, so crowded groups weigh no more than small ones.  It is
sought among ``FIRST_CELLS`` cells, then twice as many and so on up to ``MAX_CELLS_VISITED``; if that or comparing
everything is cheaper does not reach it, all vectors of the length are compared in one cell split into blocks.

Equal vectors are one class and travel once.  A cell's members, and the queries that visit it, are split into
blocks of at most ``BLOCK`` in expectation, so a crowded cell is shared by many tasks; each holds a
block of members and streams a block of queries.  A task returns link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import components, stage

COSINE = 0.95
TARGET = 0.9995
FIT_SAMPLE = 20_000
PROBE_SAMPLE = 1_000
BLOCK = 256
FIRST_CELLS = 128
MAX_CELLS_VISITED = 4096
VALUES = 1 << 21  # numbers in one array while cells are ranked


class MultiIndex:
    """Codebooks of the two halves and the order in which a query visits the product grid."""

    def __init__(self, sample: np.ndarray, size: int, rounds: int = 10):
        self.half = sample.shape[1] // 2
        self.books = [_codebook(sample[:, :self.half], size, rounds), _codebook(sample[:, self.half:], size, rounds)]

    def visits(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` nearest cells of each vector, nearest first; the first is its home.

        The cells of the ``count`` smallest sums lie among the ``count`` nearest centroids of either half.
        """
        keep = min(count, len(self.books[0])), min(count, len(self.books[1]))
        # Rank pairs with (i + 1) (j + 1) > count cannot be among the ``count`` smallest.
        widths = np.minimum(count // np.arange(1, keep[0] + 1), keep[1])
        i = np.repeat(np.arange(keep[0]), widths)
        j = np.arange(len(i)) - np.repeat(np.cumsum(widths) - widths, widths)
        step = max(1, VALUES // max(len(i), len(self.books[0]), len(self.books[1])))
        out = [np.empty((0, min(count, len(i))), np.int64)]
        for at in range(0, len(vectors), step):
            part = vectors[at:at + step]
            one, two = _distances(part[:, :self.half], self.books[0]), _distances(part[:, self.half:], self.books[1])
            first, second = np.argsort(one, 1, kind="stable")[:, :keep[0]], np.argsort(two, 1, kind="stable")[:, :keep[1]]
            a, b = np.take_along_axis(one, first, 1), np.take_along_axis(two, second, 1)
            order = np.argsort(a[:, i] + b[:, j], 1, kind="stable")[:, :count]
            out.append(np.take_along_axis(first, i[order], 1).astype(np.int64) * two.shape[1]
                       + np.take_along_axis(second, j[order], 1))
        return np.concatenate(out)


def _distances(vectors: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (vectors * vectors).sum(1)[:, None] - 2 * vectors @ book.T + (book * book).sum(1)


def _codebook(sample: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """Lloyd's iteration from evenly spaced sample rows; empty cells keep their centre."""
    book = sample[np.linspace(0, len(sample) - 1, min(size, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        nearest = _distances(sample, book).argmin(1)
        counts = np.bincount(nearest, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, sample)
        book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return book


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return flat / np.sqrt((flat * flat).sum(1))[:, None] if len(flat) else flat


def _is_usable():
    """Whether a row has an id and a vector of finite components, one of them not zero."""
    known = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    return F.coalesce(known, F.lit(False))


def _usable(vectors: DataFrame) -> DataFrame:
    """The usable vectors with their length and a hash of their values; of one component only the sign counts."""
    kind = dict(vectors.dtypes)["embedding"]
    sign = F.transform("embedding", lambda x: F.signum(x)).cast(kind)
    return (vectors.filter(_is_usable())
            .withColumn("embedding", F.when(F.size("embedding") == 1, sign).otherwise(F.col("embedding")))
            .select("vec_id", F.size("embedding").alias("dim"), "embedding",
                    F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(19), "embedding").alias("h2")))


def _by_length(part: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = part.column("dim").to_numpy()
    lengths = np.unique(dims).tolist()
    for dim in lengths:
        yield dim, part if len(lengths) == 1 else part.filter(pa.array(dims == dim))


def _samples(reps: DataFrame, size: int, salt: int) -> DataFrame:
    """At most ``size`` classes of every length, one from each hash bucket."""
    bucket = F.pmod(F.xxhash64(F.lit(salt), "h1"), F.lit(size))
    chosen = reps.groupBy("dim", bucket.alias("bucket")).agg(F.min("h1").alias("h1")).select("dim", "h1")
    return stage(reps.join(chosen, ["dim", "h1"]).select("dim", "h1", "h2", "node", "embedding"), "vector-sample")


def _sample_of(samples: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and unit vectors of one length, one length at a time on the driver."""
    found = samples.filter(F.col("dim") == dim).orderBy("h1", "h2").select("node", "embedding").toArrow()
    return found.column("node").to_numpy(), _unit(found.column("embedding").combine_chunks(), dim)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Positions of the edges that join two trees, taken in order."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, np.int64)


def _calibrate(reps: DataFrame, indexes: dict[int, MultiIndex], cosine: float, target: float, sample: int,
               most: dict[int, int]) -> dict[int, int]:
    """Cells to visit for each length: the smallest number, ``most`` at most, that finds ``target`` of a sampled vector's
    links on average; -1 if none does."""
    samples, probes = _samples(reps, sample, 23), {}
    for dim, index in indexes.items():
        ids, queries = _sample_of(samples, dim)
        probes[dim] = ids, queries, index.visits(queries, most[dim])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {dim: np.zeros((len(probes[dim][0]), n + 1), np.int64) for dim, n in most.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                for dim, part in _by_length(batch.slice(at, 2048)):
                    if dim not in probes:
                        continue
                    ids, queries, paths = probes[dim]
                    own, vectors = part.column("node").to_numpy(), _unit(part.column("embedding"), dim)
                    q, y = np.nonzero(queries @ vectors.T >= cosine)
                    other = ids[q] != own[y]
                    q, y = q[other], y[other]
                    linked, y = np.unique(y, return_inverse=True)
                    back = indexes[dim].visits(vectors[linked], most[dim])
                    step = max(1, VALUES // most[dim])
                    for one, two in ((q[k:k + step], y[k:k + step]) for k in range(0, len(q), step)):
                        ranks = [np.where(hit.any(1), hit.argmax(1), most[dim]) for hit in
                                 (paths[one] == back[two, 0][:, None], back[two] == paths[one, 0][:, None])]
                        np.add.at(seen[dim], (one, np.minimum(*ranks)), 1)
        for dim, counts in seen.items():
            probe, rank = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(probe), dim), pa.int32()), pa.array(probe), pa.array(rank), pa.array(counts[probe, rank])],
                names=["dim", "probe", "rank", "n"])

    found = (reps.select("dim", "node", "embedding").mapInArrow(run, "dim int, probe bigint, rank bigint, n bigint")
             .groupBy("dim", "probe", "rank").agg(F.sum("n").alias("n")).toArrow())
    dims, probe, rank, n = (found.column(c).to_numpy() for c in ("dim", "probe", "rank", "n"))
    visited = {}
    for dim, cells in most.items():
        links = np.zeros((len(probes[dim][0]), cells + 1))
        links[probe[dims == dim], rank[dims == dim]] = n[dims == dim]
        links = links[links.any(1)]
        recall = (np.cumsum(links[:, :cells], 1) / links.sum(1)[:, None]).mean(0) if len(links) else np.ones(1)
        reached = np.flatnonzero(recall >= target)
        visited[dim] = 1 if not len(links) else int(reached[0]) + 1 if len(reached) else -1
    return visited


def _links(sent: DataFrame, cosine: float, visited: dict[int, int]) -> DataFrame:
    """Partial results of every block: ``node, other, n`` (a tree edge, or a count with ``other`` null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "cell", "block", "part")], 1)
            place = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
            for a, b in zip(place.tolist(), [*place[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if key != tuple(keys[a]):
                    key, block = tuple(keys[a]), None
                dim = int(keys[a, 0])
                probe = part.column("probe").to_numpy(zero_copy_only=False)
                members = int((probe == 0).sum())  # members of the block come before its queries
                if members:
                    head = _Side(part.slice(0, members), dim)
                    head.path = part.slice(0, members).column("path").flatten().to_numpy().reshape(-1, visited[dim])
                    block = head if block is None else block.plus(head)
                for at in range(members, part.num_rows, 1024):
                    if block is not None:
                        yield _meet(_Side(part.slice(at, 1024), dim), block, cosine)

    return sent.mapInArrow(run, "node bigint, other bigint, n bigint")


class _Side:
    """Vectors of one side of a block: ids, copies, unit vectors, home cells and (of members) the cells they visit."""

    def __init__(self, part: pa.RecordBatch | None, dim: int):
        if part is not None:
            self.node, self.copies, self.home = (part.column(c).to_numpy() for c in ("node", "copies", "home"))
            self.unit = _unit(part.column("embedding"), dim)

    def plus(self, more: _Side) -> _Side:
        out = _Side(None, 0)
        for name in ("node", "copies", "home", "unit", "path"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(more, name)]))
        return out


def _meet(queries: _Side, block: _Side, cosine: float) -> pa.RecordBatch:
    q, y = np.nonzero(queries.unit @ block.unit.T >= cosine)
    # A pair that each finds in the other's home cell counts where the smaller id asks.
    step = max(1, VALUES // block.path.shape[1])
    mutual = np.concatenate([np.empty(0, bool), *((block.path[y[k:k + step]] == queries.home[q[k:k + step]][:, None]).any(1)
                                                  for k in range(0, len(q), step))])
    counted = (queries.node[q] != block.node[y]) & (~mutual | (queries.node[q] < block.node[y]))
    q, y = q[counted], y[counted]
    n_q, n_y = len(queries.node), len(block.node)
    tree = _forest(q, y + n_q, n_q + n_y)
    to_q = np.bincount(q, block.copies[y], n_q).astype(np.int64)
    to_y = np.bincount(y, queries.copies[q], n_y).astype(np.int64)
    some_q, some_y = np.flatnonzero(to_q), np.flatnonzero(to_y)
    node = np.concatenate([queries.node[q[tree]], queries.node[some_q], block.node[some_y]])
    n = np.concatenate([np.zeros(len(tree), np.int64), to_q[some_q], to_y[some_y]])
    other = pa.concat_arrays([pa.array(block.node[y[tree]], pa.int64()), pa.nulls(len(some_q) + len(some_y), pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), other, pa.array(n, pa.int64())], names=["node", "other", "n"])


def vector_components(vectors: DataFrame, cosine: float = COSINE, target: float = TARGET, fit_sample: int = FIT_SAMPLE,
                      probe_sample: int = PROBE_SAMPLE, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    ``n_links`` counts the other rows found with a cosine of at least ``cosine``; ``component_id`` is the
    smallest id reachable by links; ``kept`` marks the vector that bears it.  Vectors of any length are compared with
    those of the same length.  Vectors that are null, empty, zero, or hold null or non-finite components and rows
    without an id have no links and stay.  Rows of equal vectors are linked with each other, also under one id; rows of
    different vectors under one id are told apart.  Other columns are not read.
    """
    rows = vectors.select("vec_id", "embedding")
    usable = _usable(rows)
    # A class is named by a number of its own: different vectors can share their smallest id.
    reps = stage(usable.groupBy("dim", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                      F.min_by("embedding", "vec_id").alias("embedding"))
                 .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    totals = {row["dim"]: row["count"] for row in reps.groupBy("dim").count().orderBy("dim").collect()}
    samples, indexes = _samples(reps, fit_sample, 31), {}
    for dim, total in totals.items():
        size = int(min(4096, max(2, round(np.sqrt(total) / 3))))
        indexes[dim] = MultiIndex(_sample_of(samples, dim)[1], size)
    # All pairs send a vector to total / block blocks on either side: beyond that many cells a grid saves nothing.
    limit = {dim: min(len(index.books[0]) * len(index.books[1]), MAX_CELLS_VISITED, max(FIRST_CELLS, 2 * totals[dim] // block))
             for dim, index in indexes.items()}
    most, visited = {dim: min(FIRST_CELLS, n) for dim, n in limit.items()}, {}
    while most:
        visited |= _calibrate(reps, {dim: indexes[dim] for dim in most}, cosine, target, probe_sample, most)
        most = {dim: min(2 * n, limit[dim]) for dim, n in most.items() if visited[dim] < 0 and n < limit[dim]}
    for dim in visited:
        if visited[dim] < 0:
            indexes[dim], visited[dim] = MultiIndex(np.zeros((1, dim)), 1), 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for dim, part in _by_length(batch.slice(at, 1024)):
                    path = indexes[dim].visits(_unit(part.column("embedding"), dim), visited[dim])
                    offsets = pa.array(np.arange(len(path) + 1) * path.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(path.ravel()))], names=[*part.schema.names, "path"])

    kind = dict(reps.dtypes)["embedding"]
    placed = stage(reps.select("dim", "node", "copies", "embedding").mapInArrow(
        place, f"dim int, node bigint, copies bigint, embedding {kind}, path array<bigint>"), "vector-paths")
    home = F.get("path", F.lit(0))
    parts_of = lambda n: F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(n)
    asked = placed.select("dim", F.explode("path").alias("cell")).groupBy("dim", "cell").agg(parts_of("parts"))
    cells = stage(placed.groupBy("dim", home.alias("cell")).agg(parts_of("blocks")).join(asked, ["dim", "cell"]), "vector-cells")
    members = (placed.withColumn("cell", home).join(cells, ["dim", "cell"])
               .select("dim", "cell", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("probe"),
                       "node", "copies", "embedding", home.alias("home"), "path"))
    # Only members are asked which cells they visit; a query carries its home.
    asks = placed.select("dim", "node", "copies", "embedding", home.alias("home"), F.explode("path").alias("cell")).join(cells, ["dim", "cell"])
    asks = asks.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                       F.pmod(F.xxhash64(F.lit(37), "node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("probe"),
                       "node", "copies", "embedding", "home", F.lit(None).cast("array<bigint>").alias("path"))
    keys = ["dim", "cell", "block", "part"]
    sent = members.unionByName(asks).repartition(*keys).sortWithinPartitions(*keys, "probe")
    found = stage(_links(sent, cosine, visited), "vector-links")
    edges = found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    met = components(vectors.sparkSession, edges, "vector-cc")
    lowest = (met.join(reps.select(F.col("node").alias("id"), "rep"), "id")
              .groupBy("component").agg(F.min("rep").alias("lowest")))
    counts = found.filter("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    classes = (reps.select("dim", "h1", "h2", "node", "rep", "copies").join(counts, "node", "left")
               .join(met.join(lowest, "component").select(F.col("id").alias("node"), "lowest"), "node", "left")
               .select("dim", "h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                       F.coalesce("lowest", "rep").alias("component_id")))
    classes = stage(classes, "vector-results")
    linked = (usable.select("vec_id", "dim", "h1", "h2").join(classes, ["dim", "h1", "h2"])
              .select("vec_id", "n_links", "component_id"))
    others = rows.filter(~_is_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of the whole ``embeddings`` table."""
    return vector_components(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
