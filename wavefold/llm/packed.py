"""Exchange of many small ``(hash, document, position)`` entries as packed blobs.

Corpus-wide matching needs an entry for every block or window of every text.  As table
rows they would cost several times their content in the shuffle, so a task groups its entries by
target part and sends one blob per part: documents and positions as compressed
differences, hashes raw.  Spark partitions, shuffles and sorts the blobs; a
reducer opens one part at a time.  Parts grow in number with the input, never in size.

An item that repeats inside one task is settled there as far as possible and sent once, so an item
that a third of all documents share sends one entry per task, not one per document.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wavefold.llm.common import partitions_for, stage

FLUSH_BYTES = 16 << 20
BLOBS = "part int, target int, blob binary"
_HEAD = struct.Struct("<IIIB")


def distinct_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that take part (one per non-null ``doc_id``) and the rest.

    Of rows that share a ``doc_id`` the one with the smallest text hash takes part; the others, and
    rows without an id, pass through unchanged.
    """
    known = docs.filter("doc_id IS NOT NULL")
    repeated = stage(known.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return known, docs.filter("doc_id IS NULL")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    ranked = stage(known.join(repeated, "doc_id", "left_semi").withColumn("_copy", F.row_number().over(order)), "repeated-rows")
    first = known.join(repeated, "doc_id", "left_anti").unionByName(ranked.filter("_copy = 1").drop("_copy"))
    return first, docs.filter("doc_id IS NULL").unionByName(ranked.filter("_copy > 1").drop("_copy"))


def pack(doc: np.ndarray, pos: np.ndarray, extra: np.ndarray) -> bytes:
    """A blob of entries ordered by ``doc``; ``extra`` has one fixed-width item for each, or none at all."""
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    counts = np.diff(np.append(starts, len(doc))).astype(np.int32)
    docs = np.diff(doc[starts].astype(np.int64), prepend=np.int64(0))
    steps = np.diff(pos.astype(np.int32), prepend=np.int32(0)).astype(np.int32)
    steps[starts] = pos[starts]
    meta = zstandard.compress(docs.tobytes() + counts.tobytes() + steps.tobytes(), 1)
    return _HEAD.pack(len(doc), len(starts), len(meta), bool(len(extra))) + meta + extra.tobytes()


def unpack(blob: bytes, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, n_docs, n_meta, has_extra = _HEAD.unpack_from(blob)
    at = _HEAD.size
    meta = zstandard.decompress(blob[at:at + n_meta])
    docs = np.cumsum(np.frombuffer(meta, np.int64, n_docs))
    counts = np.frombuffer(meta, np.int32, n_docs, n_docs * 8)
    steps = np.frombuffer(meta, np.int32, n, n_docs * 12).astype(np.int64)
    total = np.cumsum(steps)
    first = np.cumsum(counts) - counts
    pos = total - np.repeat(total[first] - steps[first], counts)
    extra = np.frombuffer(blob, kind, n, at + n_meta) if has_extra else np.empty(0, kind)
    return np.repeat(docs, counts), pos, extra


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit key, by its upper half."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def doc_part(doc: np.ndarray, parts: int) -> np.ndarray:
    mixed = doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return part_of(mixed ^ (mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9), parts)


def split_parts(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The entries of each part in their present order."""
    if not len(part):
        return
    kind = np.uint16 if part.max() < 1 << 16 else np.uint32
    order = np.argsort(part.astype(kind), kind="stable")
    ranked = part[order]
    edges = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1, [len(ranked)]])
    shuffled = [c[order] for c in columns]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(ranked[a]), [c[a:b] for c in shuffled]


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, target, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(target, pa.int32()), pa.array(blob, pa.binary())], names=["part", "target", "blob"])


def settled(doc: np.ndarray, pos: np.ndarray, parts: int, carrier: int | None = None) -> list[tuple[int, int, bytes]]:
    """Rows that carry found ``(doc, pos)`` entries to the part of their document (``target``).

    ``carrier`` spreads them over the first exchange; entries must be ordered by document.
    """
    empty = np.empty(0, np.uint8)
    return [((target if carrier is None else (target + carrier) % parts), target, pack(d, p, empty))
            for target, (d, p) in split_parts(doc_part(doc, parts), doc, pos)]


def by_part(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Groups consecutive rows of one ``column`` value: ``(value, [(target, blob), ...])``."""
    now, held = None, []
    for batch in batches:
        keys = batch.column(column).to_pylist()
        targets, blobs = batch.column("target").to_pylist(), batch.column("blob").to_pylist()
        for key, target, blob in zip(keys, targets, blobs, strict=True):
            if key != now:
                if held:
                    yield now, held
                now, held = key, []
            held.append((target, blob))
    if held:
        yield now, held


def exchange(docs: DataFrame, emit: Callable, judge: Callable, kind: np.dtype, parts: int) -> DataFrame:
    """``doc_id, found`` (sorted distinct positions, int32 little-endian) for documents with findings.

    ``emit(batches, parts)`` yields rows ``(part, target, blob)`` from ``docs``: entries for the
    part of their hash (``target`` is -1), or findings already certain (see :func:`settled`).
    ``judge(doc, pos, extra)`` gets all entries of a part and returns the found ``(doc, pos)``.
    """
    def send(batches):
        for rows in emit(batches, parts):
            for at in range(0, len(rows), 256):
                yield blob_batch(rows[at:at + 256])

    def reduce(batches):
        for _, held in by_part(batches, "part"):
            passed = [(t, t, b) for t, b in held if t >= 0]
            if passed:
                yield blob_batch(passed)
            entries = [unpack(b, kind) for t, b in held if t < 0]
            if entries:
                doc, pos = judge(*[np.concatenate(c) for c in zip(*entries, strict=True)])
                if len(doc):
                    order = np.lexsort((pos, doc))
                    yield blob_batch(settled(doc[order], pos[order], parts))

    empty = np.dtype(np.uint8)

    def merge(batches):
        for _, held in by_part(batches, "target"):
            doc, pos = (np.concatenate(c) for c in list(zip(*[unpack(b, empty) for _, b in held], strict=True))[:2])
            order = np.lexsort((pos, doc))
            doc, pos = doc[order], pos[order]
            fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
            doc, pos = doc[fresh], pos[fresh].astype("<i4")
            starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            ends = np.append(starts[1:], len(doc))
            found = [pos[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            for at in range(0, len(starts), 1024):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[starts[at:at + 1024]], pa.int64()), pa.array(found[at:at + 1024], pa.binary())],
                    names=["doc_id", "found"])

    sent = docs.mapInArrow(send, BLOBS).repartition(parts, "part").sortWithinPartitions("part")
    found = sent.mapInArrow(reduce, BLOBS).repartition(parts, "target").sortWithinPartitions("target")
    return found.mapInArrow(merge, "doc_id bigint, found binary")


def exchange_parts(docs: DataFrame) -> int:
    return partitions_for(docs, "text")


def flushes(batches: Iterator[pa.RecordBatch], limit: int = FLUSH_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` bytes of text, so a task holds that much at once."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * limit / max(limit, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
