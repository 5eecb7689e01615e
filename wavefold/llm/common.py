"""Shared pieces: staged tables, hashing of text spans, connected components.

Nothing here keeps state on an executor: what must outlive a job is written as
Parquet under ``spark.checkpoint.dir`` and read back, so a lost executor costs
a retry of its tasks and nothing more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.session import staging_path

# The characters that [\x20\x09-\x0D] names.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back (lineage ends here)."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bounded_sample(df: DataFrame, key: str, size: int, salt: int) -> DataFrame:
    """At most ``size`` values of ``key``, one from each of ``size`` hash buckets.

    A map-side minimum: no task and no driver handles more than ``size`` candidates, however many rows there are.
    """
    known = df.filter(F.col(key).isNotNull()).select(key)
    bucket = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(size))
    return known.groupBy(bucket.alias("bucket")).agg(F.min(key).alias(key)).select(key)


def compressed(texts: DataFrame) -> DataFrame:
    """``doc_id, packed``: whole texts as zstd blobs, less than half as long in an exchange (null stays null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                blobs = [None if t is None else pack(t.encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(blobs, pa.binary())], names=["doc_id", "packed"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id bigint, packed binary")


def text_slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Row slices of ``compressed`` batches whose texts have about ``limit`` bytes when unpacked (one row at least)."""
    for batch in batches:
        sizes = [0 if b is None else zstandard.frame_content_size(b) for b in batch.column("packed").to_pylist()]
        ends = np.cumsum(np.array(sizes, np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            end = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, end - first)
            first = end


def uncompressed(blobs: list[bytes | None]) -> list[str | None]:
    """The texts of ``compressed`` blobs."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [None if b is None else unpack(b).decode() for b in blobs]


def partitions_for(docs: DataFrame, column: str, bytes_each: int = 16 << 20) -> int:
    """Number of parts that keeps each near ``bytes_each`` of ``column``."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(floor, -(-total // bytes_each))


def ascii_lower(col):
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


# ---------------------------------------------------------------- text spans

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place): every input bit reaches every output bit."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(lower: bool) -> np.ndarray:
    seeds = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = mix(seeds)
    if lower:
        values[65:91] = values[97:123]
    return values


_BYTES = {False: _byte_table(False), True: _byte_table(True)}
_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1024)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _POWERS[name] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, from one running sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.empty(len(data) + 1, np.uint64)
        self._sums[0] = 0
        values = _BYTES[lower][data]
        values *= up[: len(data)]
        np.cumsum(values, out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self._sums[end] - self._sums[start]
        out *= self._down[start]
        out += (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        return mix(out)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive hashes (length ``n - size + 1``)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k:k + n]
    return mix(out)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` over whole texts, about ``limit`` bytes each; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    rows = len(column)
    if not rows:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + rows + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(rows, max(first + 1, end))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def _edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of maximal runs of ``inside`` that don't cross ``offsets``."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word ``[^\\x20\\x09-\\x0D]+``."""
    start, end = _edges(~_SPACE[data], offsets)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each ``\\n``-split line; an empty text has one."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    owner = np.searchsorted(breaks, offsets)  # breaks before each text
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(owner) + 1)
    # In sorted order a text's own start precedes those after its breaks; an empty text shares its offset.
    end = np.empty(len(start), np.int64)
    end[:-1] = np.where(texts[1:] == texts[:-1], start[1:] - 1, 0)
    end[-1:] = 0
    last = np.flatnonzero(np.append(texts[1:] != texts[:-1], True))
    end[last] = offsets[1:][texts[last]]
    return start, end, texts


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


# ------------------------------------------------------- connected components

def components(spark: SparkSession, edges: DataFrame, label: str = "cc") -> DataFrame:
    """Smallest reachable id for every id in ``edges(a, b)``: ``(id, component)``.

    Each round takes the smallest label among the neighbours (map-side minimum,
    skewed hubs split by adaptive execution) and then jumps to the label of the
    label, so paths shorten by halves.  It ends when no label changes; the labels of each round
    are a staged table, so neither lineage nor driver memory grows with the graph.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = stage(pairs.union(pairs.select("b", "a")).distinct(), f"{label}-edges")
    state = stage(both.groupBy("a").agg(F.min("b").alias("low"))
                  .select(F.col("a").alias("id"), F.least("a", "low").alias("component")), f"{label}-labels")
    while True:
        heard = (both.join(state.select(F.col("id").alias("b"), "component"), "b")
                 .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard")))
        met = stage(state.join(heard, "id", "left")
                    .select("id", F.col("component").alias("before"),
                            F.least("component", "heard").alias("now")), f"{label}-heard")
        jump = met.select(F.col("id").alias("now"), F.col("now").alias("further"))
        after = stage(met.join(jump, "now", "left")
                      .select("id", "before", F.least("now", "further").alias("component")), f"{label}-labels")
        if after.filter("component <> before").isEmpty():
            return after.select("id", "component")
        state = after.select("id", "component")
