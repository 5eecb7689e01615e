"""Word-level substring deduplication with fixed-block anchors.

Reference blocks are the non-overlapping runs of ``BLOCK`` words that start at multiples of
``BLOCK``; every rolling window of ``BLOCK`` words probes them.  Twenty words always
contain a whole reference block, so of two equal windows the earlier one holds a
block that the later one probes: every repeat is hit.  The hits are then extended: each window
of ``WINDOW`` words around a hit is compared with all others by its full hash,
and the confirmed windows merge into maximal repeats.

Two packed exchanges (see ``packed``) carry probes and windows; the text, compressed, is joined by
document, and only documents with hits take part in the second half.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm import packed
from wavefold.llm.common import SpanHasher, compressed, rolling, stage, text_chunks, text_slices, uncompressed, word_spans

WINDOW = 20
BLOCK = 10
SMALL, LARGE = np.dtype(np.uint32), np.dtype(np.uint64)


def _windows(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, first word, hash)`` of every run of ``size`` words inside one text, in row order."""
    for first, _, data, offsets in text_chunks(column):
        start, end, owner = word_spans(data, offsets)
        if len(start) < size:
            continue
        hashes = rolling(SpanHasher(data).spans(start, end), size)
        inside = np.flatnonzero(owner[:len(hashes)] == owner[size - 1:])
        first_word = np.searchsorted(owner, owner[inside])
        yield owner[inside] + first, inside - first_word, hashes[inside]


def _gathered(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = list(_windows(column, size))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, and the start of each group in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))


def _hit(keys: np.ndarray, is_block: np.ndarray) -> np.ndarray:
    """Entries whose key occurs at two places at least, one of them a reference block."""
    if not len(keys):
        return np.zeros(0, bool)
    order, starts = _groups(keys)
    sizes = np.diff(np.append(starts, len(keys)))
    good = (sizes > 1) & (np.add.reduceat(is_block[order].astype(np.int64), starts) > 0)
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(good, sizes)
    return out


def _emit_probes(block: int):
    def emit(batches, parts):
        for turn, batch in enumerate(packed.flushes(batches, packed.FLUSH_BYTES // 2)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            row, pos, keys = _gathered(batch.column("text"), block)
            order = np.argsort(ids, kind="stable")  # entries go in document order
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            if len(ids) and (np.diff(ids) < 0).any():
                turn_order = np.argsort(rank[row], kind="stable")
                row, pos, keys = row[turn_order], pos[turn_order], keys[turn_order]
            doc, is_block = ids[row], pos % block == 0
            known = _hit(keys, is_block)
            rows = packed.settled(doc[known], pos[known], parts, turn)
            # Of a key settled here one reference block goes on, for the other tasks.
            lead = np.zeros(len(keys), bool)
            blocks = np.flatnonzero(known & is_block)
            lead[blocks[np.unique(keys[blocks], return_index=True)[1]]] = True
            going = ~known | lead
            doc, pos, keys = doc[going], pos[going], keys[going]
            rows += [(part, -1, packed.pack(d, p, k)) for part, (d, p, k) in
                     packed.split_parts(packed.part_of(keys, parts), doc, pos, keys.astype(np.uint32))]
            yield rows
    return emit


def _judge_probes(block: int):
    def judge(doc, pos, extra):
        found = _hit(extra, pos % block == 0)
        return doc[found], pos[found]
    return judge


def _later(doc: np.ndarray, pos: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Entries that are not the earliest of their key."""
    order = np.lexsort((pos, doc, keys))
    ranked = keys[order]
    out = np.empty(len(keys), bool)
    out[order] = np.concatenate([[False], ranked[1:] == ranked[:-1]]) if len(keys) else np.zeros(0, bool)
    return out


def _emit_windows(window: int, block: int):
    def emit(batches, parts):
        for turn, batch in enumerate(text_slices(batches, packed.FLUSH_BYTES // 4)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            row, pos, keys = _gathered(pa.array(uncompressed(batch.column("packed").to_pylist()), pa.large_string()), window)
            # A window is a candidate if one of its blocks was hit.
            near = []
            for n, hits in enumerate(batch.column("found").to_pylist()):
                at = np.frombuffer(hits, "<i4").astype(np.int64)
                near.append((np.int64(n) << 40) + at)
            hit = np.concatenate(near) if near else np.empty(0, np.int64)
            place = (row.astype(np.int64) << 40) + pos
            candidate = np.searchsorted(hit, place) < np.searchsorted(hit, place + window - block, "right")
            doc, pos, keys = ids[row[candidate]], pos[candidate], keys[candidate]
            known = _later(doc, pos, keys)
            order = np.argsort(doc[known], kind="stable")
            rows = packed.settled(doc[known][order], pos[known][order], parts, turn)
            doc, pos, keys = doc[~known], pos[~known], keys[~known]
            order = np.argsort(doc, kind="stable")
            doc, pos, keys = doc[order], pos[order], keys[order]
            rows += [(part, -1, packed.pack(d, p, k)) for part, (d, p, k) in
                     packed.split_parts(packed.part_of(keys, parts), doc, pos, keys)]
            yield rows
    return emit


def _judge_windows(doc, pos, extra):
    found = _later(doc, pos, extra)
    return doc[found], pos[found]


def _kept(text: str | None, starts: np.ndarray, window: int) -> tuple[int, int, str]:
    """Words, removed words and kept text of one document, given the starts of its repeated windows."""
    words = (text or "").split("\n")
    words = [w for line in words for w in _split(line)]
    if not len(starts):
        return len(words), 0, " ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.minimum(starts + window, len(words)), -1)
    gone = np.cumsum(cover[:-1]) > 0
    return len(words), int(gone.sum()), " ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


_TO_SPACE = str.maketrans("\t\x0b\x0c\r", "    ")


def _split(line: str) -> list[str]:
    return [w for w in line.translate(_TO_SPACE).split(" ") if w]


def substring_dedup(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs(doc_id, text)``.

    A word goes if a run of ``window`` words that covers it also starts earlier
    (smaller ``doc_id``, or same document and earlier start); ``kept`` has the other words
    joined by one space, or with ``digest`` its SHA-256, so that unchanged texts are not written out.
    Null or empty text: no words.  Of rows that share a ``doc_id`` one takes part (see
    ``packed.distinct_documents``); the others, and rows without an id, lose nothing.  Other columns are not read.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block: window >= 2 * block - 1")

    def finish(text: str | None, starts: bytes | None) -> tuple[int, int, str]:
        n, gone, kept = _kept(text, np.frombuffer(starts or b"", "<i4").astype(np.int64), window)
        return n, gone, hashlib.sha256(kept.encode()).hexdigest() if digest else kept

    def without_hits(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                hits, blobs = part.column("found").to_pylist(), part.column("packed").to_pylist()
                texts = uncompressed([None if h is not None else b for b, h in zip(blobs, hits, strict=True)])
                done = [(None, None, None) if h is not None else finish(t, None) for t, h in zip(texts, hits, strict=True)]
                going = [None if h is None else b for b, h in zip(blobs, hits, strict=True)]
                yield _rows(part, done, packed=pa.array(going, pa.binary()), found=part.column("found"))

    def with_windows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield _rows(part, [finish(t, f) for t, f in zip(
                    uncompressed(part.column("packed").to_pylist()), part.column("found").to_pylist(), strict=True)])

    result = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    own, rest = packed.distinct_documents(docs.select("doc_id", "text"))
    parts = packed.exchange_parts(own)
    hits = packed.exchange(own, _emit_probes(block), _judge_probes(block), SMALL, parts)
    marked = compressed(own).join(hits, "doc_id", "left").unionByName(compressed(rest).withColumn("found", F.lit(None).cast("binary")))
    first = stage(marked.select("doc_id", "packed", "found").mapInArrow(
        without_hits, f"{result}, packed binary, found binary"), "anchor-hits")
    involved = first.filter("found IS NOT NULL").select("doc_id", "packed", "found")
    starts = packed.exchange(involved, _emit_windows(window, block), _judge_windows, LARGE, parts)
    second = involved.select("doc_id", "packed").join(starts, "doc_id", "left").mapInArrow(with_windows, result)
    return first.filter("found IS NULL").select("doc_id", "n_words", "n_removed", "kept").unionByName(second)


def _rows(part: pa.RecordBatch, done: list[tuple], **more: pa.Array) -> pa.RecordBatch:
    n, gone, kept = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), *more.values()],
        names=["doc_id", "n_words", "n_removed", "kept", *more])


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Substring deduplication of the whole ``documents`` table, digested per document."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM tokens)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM tokens),
marks AS (
  SELECT w.doc_id, w.i, w.word,
         coalesce(sum(CASE WHEN r.r > 1 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM words w LEFT JOIN ranked r ON r.doc_id = w.doc_id AND r.i = w.i),
kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS g,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS t
  FROM marks GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(g, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM tokens LEFT JOIN kept USING (doc_id)
"""
