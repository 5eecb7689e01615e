"""Vector code compression: product codes assigned by Orchard's search.

Integer vectors are cut into equal parts, each with a codebook.  The nearest entry of a part is found by Orchard's search:
every entry has the list of all entries in order of their distance to it; the list of the best entry so far is
followed, a better entry is jumped to and its list begun, visited entries are not measured again, and
the search ends where the list goes beyond twice the current distance (all in squares, so four times), as the triangle inequality leaves
nothing nearer there.  The search runs for all rows of a batch at once.

A round adds up the members of every entry in each task and sends one sum for each entry and component, so what reaches the
driver is the size of the codebooks; those are sent to the tasks (64 entries x the vector length, whatever the number of rows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm.common import stage, table, unused
from wavefold.llm.vectors import by_length, lengths, measured, whole
from wavefold.session import ship_package

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2


class Codebook:
    """Entries of one part with, for each, all entries in order of distance (ties to the lower index)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
        self.order = np.argsort(apart, 1, kind="stable")
        self.gaps = np.take_along_axis(apart, self.order, 1)
        # A search begins at the entry nearest in the component that spreads most.
        self.axis = int(np.argmax(entries.max(0) - entries.min(0)))
        self.ladder = np.argsort(entries[:, self.axis], kind="stable")
        values = entries[self.ladder, self.axis]
        self.steps = (values[1:] + values[:-1]) / 2

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row; equal distances go to the lower index."""
        rows, size = len(x), len(self.entries)
        best = self.ladder[np.searchsorted(self.steps, x[:, self.axis])]
        far = ((x - self.entries[best]) ** 2).sum(1)
        visited = np.zeros((rows, size), bool)
        visited[np.arange(rows), best] = True
        place = np.zeros(rows, np.int64)
        busy = np.arange(rows)
        while len(busy):
            at, to = best[busy], place[busy]
            inside = to < size
            inside[inside] = self.gaps[at[inside], to[inside]] <= 4 * far[busy[inside]]
            busy, at, to = busy[inside], at[inside], to[inside]
            entry = self.order[at, to]
            place[busy] += 1
            fresh = ~visited[busy, entry]
            seekers, entry = busy[fresh], entry[fresh]
            visited[seekers, entry] = True
            apart = ((x[seekers] - self.entries[entry]) ** 2).sum(1)
            better = (apart < far[seekers]) | ((apart == far[seekers]) & (entry < best[seekers]))
            movers = seekers[better]
            best[movers], far[movers], place[movers] = entry[better], apart[better], 0
        return best, far


class Books:
    """The codebooks of one vector length."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # part, entry, component
        self.books = [Codebook(part) for part in entries]

    @classmethod
    def of(cls, first: np.ndarray, parts: int) -> Books:
        return cls(np.stack(np.split(_padded(first, parts), parts, 1)))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part of every row, and the squared distances."""
        found = [book.nearest(part) for book, part in zip(self.books, np.split(x, len(self.books), 1), strict=True)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Books:
        """Entries replaced by the floor of their members' mean; an entry without members stays."""
        means = sums // np.maximum(counts, 1)[:, :, None]
        return Books(np.where(counts[:, :, None] > 0, means, self.entries))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _padded(x: np.ndarray, parts: int) -> np.ndarray:
    """``x`` with zeros behind it, so that its length is a multiple of ``parts`` (one component a part at least)."""
    width = parts * max(1, -(-x.shape[1] // parts))
    if x.size and 4 * width * float(np.abs(x).max()) ** 2 >= 2.0 ** 60:
        raise ValueError("squared distances exceed 64 bits")
    return x if width == x.shape[1] else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _sums(rows: DataFrame, books: dict[int, Books], scale: int, parts: int) -> dict[int, Books]:
    """The codebooks after one round over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for dim, batch in by_length(batches):
            book = books[dim]
            x = _padded(whole(batch.column("embedding"), dim, scale), parts)
            sums, counts = totals.setdefault(dim, (np.zeros_like(book.entries), np.zeros(book.entries.shape[:2], np.int64)))
            codes, _ = book.assign(x)
            for part, (code, piece) in enumerate(zip(codes.T, np.split(x, parts, 1), strict=True)):
                np.add.at(sums[part], code, piece)
                counts[part] += np.bincount(code, minlength=counts.shape[1])
        for dim, (sums, counts) in totals.items():
            part, entry = np.nonzero(counts)
            width = sums.shape[2]
            wide = lambda a: pa.array(np.repeat(a, width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part) * width, dim), pa.int32()), pa.array(np.repeat(part, width), pa.int32()),
                 pa.array(np.repeat(entry, width), pa.int32()), pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
                 pa.array(sums[part, entry].ravel()), wide(counts[part, entry])], names=["dim", "part", "entry", "position", "total", "n"])

    found = (rows.select("dim", "embedding").mapInArrow(run, "dim int, part int, entry int, position int, total bigint, n bigint")
             .groupBy("dim", "part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow())
    column = {c: found.column(c).to_numpy() for c in found.column_names}
    moved = {}
    for dim, book in books.items():
        here = column["dim"] == dim
        part, entry, position = (column[c][here] for c in ("part", "entry", "position"))
        sums, counts = np.zeros_like(book.entries), np.zeros(book.entries.shape[:2], np.int64)
        sums[part, entry, position] = column["total"][here]
        counts[part, entry] = column["n"][here]
        moved[dim] = book.moved(sums, counts)
    return moved


def product_codes(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every row of ``vectors(vec_id, embedding, label)`` with a finite vector.

    Components count as ``floor(scale * component)``.  The ``entries`` rows with the smallest ids (null last, then by vector) give the
    first codebooks; with fewer rows the codebooks are as small.  ``rounds`` times all parts are assigned and the entries replaced by the floor
    of their members' mean; then the parts are assigned for good.  ``code`` has two hex digits a part (at most 256 entries),
    ``error`` the squared distances summed over the parts, ``label_error`` the sum of ``error`` over the rows of the same label, nulls
    together.  Repeated rows count as often as they occur.  Vectors of each length have codebooks of their own; a length that is no
    multiple of ``parts`` is filled up with zeros.  Null vectors and those with null or non-finite components are dropped; an empty table
    gives no rows.  Other columns are not read.  Numbers whose squared distances exceed 64 bits are an error.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(measured(vectors, "vec_id", "label"), "code-rows")
    books = {}
    for dim in lengths(rows):
        first = (rows.filter(F.col("dim") == dim).orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries)
                 .select("embedding").toArrow().column("embedding").combine_chunks())
        books[dim] = Books.of(whole(first, dim, scale), parts)
    for _ in range(rounds):
        books = _sums(rows, books, scale, parts)
    return _coded(spark, rows, books, scale, parts)


def _coded(spark: SparkSession, rows: DataFrame, books: dict[int, Books], scale: int, parts: int) -> DataFrame:
    digests = {dim: book.digest() for dim, book in books.items()}
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in by_length(batches):
            codes, far = books[dim].assign(_padded(whole(batch.column("embedding"), dim, scale), parts))
            code = ["".join(row) for row in digits[codes].tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(far.sum(1)),
                 pa.array([digests[dim]] * len(code), pa.string())], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    kind = dict(rows.dtypes)
    schema = f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error bigint, codebooks_sha256 string"
    coded = stage(rows.mapInArrow(run, schema), "codes")
    name, total = unused(coded, "of_label", "label_error")
    sums = coded.groupBy(F.col("label").alias(name)).agg(F.sum("error").alias(total))
    return coded.join(sums, F.col("label").eqNullSafe(F.col(name))).select(
        "vec_id", "code", "error", F.col(total).alias("label_error"), "codebooks_sha256")


def op12_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the whole ``embeddings`` table: 16 parts, 64 entries, two rounds."""
    return product_codes(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The rounds written out in SQL: every part against every entry."""
    near = """
{name}p AS (
  SELECT p.r, p.part, arg_min(b.entry, (list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.entry)) AS entry,
         min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS far
  FROM p JOIN {book} b USING (part) GROUP BY p.r, p.part)"""
    move = """
{name} AS (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
    SELECT part, entry, list(CAST(floor(s::DOUBLE / n) AS BIGINT) ORDER BY i) AS x FROM (
      SELECT a.part, a.entry, i, sum(p.x[i]) AS s, count(*) AS n FROM {near}p a JOIN p USING (r, part), generate_series(1, len(p.x)) g(i)
      GROUP BY a.part, a.entry, i) GROUP BY part, entry) m USING (part, entry))"""
    steps = []
    for k in range(ROUNDS):
        steps += [near.format(name=f"a{k}", book=f"b{k}"), move.format(name=f"b{k + 1}", book=f"b{k}", near=f"a{k}")]
    steps.append(near.format(name="z", book=f"b{ROUNDS}"))
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT r, part, x[part * (len(x) // {PARTS}) + 1 : (part + 1) * (len(x) // {PARTS})] AS x FROM v, range({PARTS}) t(part)),
b0 AS (SELECT part, r - 1 AS entry, x FROM p WHERE r <= {ENTRIES}),{",".join(steps)},
e AS (
  SELECT v.vec_id, v.label, string_agg(lpad(to_hex(z.entry), 2, '0'), '' ORDER BY z.part) AS code, CAST(sum(z.far) AS BIGINT) AS error
  FROM zp z JOIN v USING (r) GROUP BY v.r, v.vec_id, v.label),
h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e, h
"""


ORACLE = _oracle()
