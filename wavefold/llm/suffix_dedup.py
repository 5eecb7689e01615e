"""Byte-level deduplication by interval expansion on a Burrows-Wheeler transform.

Repeats of ``length`` bytes are found in two steps.

*Anchors.*  In every ``length``-byte window the byte grams with the smallest hash are
anchors, so equal windows have equal anchors at equal places.  Anchors meet in a packed
exchange together with a hash of all bytes that windows around them can reach (the *context*).  A repeated context
settles at once: every window in it starts earlier.  An anchor that is met with several
different contexts is *mixed*.

*Intervals.*  The first occurrences of the contexts of a mixed anchor are put in
suffix order from the anchor on.  All suffixes that begin with the anchor are one interval of the suffix order;
breadth-first backward extension splits it by the preceding byte, one byte a level, as the
transform's last-to-first step does.  At level ``a`` members of one interval share ``a`` bytes before
the anchor, and neighbours whose common prefix after it reaches ``length - a`` bytes start equal
windows.  Levels grow from zero and stop at the length; an interval with one member, or whose members can
no longer reach the length, is not extended.

An anchor with more contexts than one task should hold is settled by a map-side minimum over window hashes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm import packed
from wavefold.llm.common import SpanHasher, mix, runs, stage, text_chunks

LENGTH = 100
GRAM = 16
GROUP_LIMIT = 50_000
ENTRY = np.dtype([("key", "<u4"), ("context", "<u8")])
FULL, MIXED = 0, 1


def _slide(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``size`` values, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def anchors(column: pa.Array, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, byte position, anchor hash, context hash)`` in row order; texts shorter than ``length`` have none."""
    out = []
    reach = length - gram  # a window starts at most this far before its anchor
    for first, _, data, offsets in text_chunks(column):
        n = len(data)
        if n < length:
            continue
        hasher = SpanHasher(data)
        at = np.arange(n - gram + 1)
        keys = hasher.spans(at, at + gram)
        small = (keys >> np.uint64(32)).astype(np.uint32)
        low = _slide(small, reach + 1, np.minimum)  # of the window that starts here
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        valid = owner[:n - length + 1] == owner[length - 1:]
        # A gram is an anchor if it equals the smallest value of a whole window around it.
        best = np.zeros(len(small) + reach, np.uint32)
        best[reach:reach + len(low)] = np.where(valid, low, 0)
        covered = np.zeros(len(best), bool)
        covered[reach:reach + len(low)] = valid
        top = _slide(best, reach + 1, np.maximum)
        chosen = np.flatnonzero((top == small) & _slide(covered, reach + 1, np.logical_or))
        doc = owner[chosen]
        left = np.maximum(offsets[doc], chosen - reach)
        right = np.minimum(offsets[doc + 1], chosen + length)
        context = hasher.spans(left, right) + (chosen - left).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out.append((doc + first, chosen - offsets[doc], keys[chosen], mix(context)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def anchor_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each anchor.  Anchors are the grams with the smallest upper half of the hash, so it is mixed again first."""
    return packed.part_of(mix(keys.copy()), parts)


def _emit_anchors(length: int, gram: int):
    def emit(batches, parts):
        for turn, batch in enumerate(packed.flushes(batches)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            row, pos, keys, context = anchors(batch.column("text"), length, gram)
            doc = ids[row]
            order = np.lexsort((pos, doc, context, keys))
            same = np.zeros(len(order), bool)
            same[1:] = (np.diff(keys[order]) == 0) & (np.diff(context[order]) == 0)
            later = np.zeros(len(order), bool)
            later[order] = same
            by_doc = np.lexsort((pos, doc))
            settled = by_doc[later[by_doc]]
            rows = packed.settled(doc[settled], 2 * pos[settled] + FULL, parts, turn)
            going = by_doc[~later[by_doc]]
            entries = np.empty(len(going), ENTRY)
            entries["key"], entries["context"] = keys[going].astype(np.uint32), context[going]
            rows += [(part, -1, packed.pack(d, p, e)) for part, (d, p, e) in
                     packed.split_parts(anchor_part(keys[going], parts), doc[going], pos[going], entries)]
            yield rows
    return emit


def _judge_anchors(doc, pos, entries):
    """Later occurrences of a context are FULL; first ones are MIXED if their anchor has several contexts."""
    key, context = entries["key"], entries["context"]
    order = np.lexsort((pos, doc, context, key))
    key, context = key[order], context[order]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_context = new_key | np.concatenate([[True], context[1:] != context[:-1]])
    group = np.cumsum(new_key) - 1
    several = np.bincount(group, new_context)[group] > 1
    full, mixed = ~new_context, new_context & several
    found = full | mixed
    return doc[order][found], (2 * pos[order] + np.where(mixed, MIXED, FULL))[found]


def _cover(spans: list[tuple[int, int]], n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for a, b in spans:
        edge[a] += 1
        edge[b] -= 1
    return np.cumsum(edge[:-1]) > 0


def _full_spans(codes: np.ndarray, n: int, length: int, gram: int) -> np.ndarray:
    """``[start, end)`` pairs of the contexts that repeat (those that hold a whole window)."""
    pos = codes[codes % 2 == FULL] // 2
    start, end = np.maximum(0, pos - (length - gram)), np.minimum(n, pos + length)
    whole = end - start >= length
    return np.stack([start[whole], end[whole]], 1)


def _common(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest entry of ``table[0][low + 1:high + 1]`` for each pair ``low < high``."""
    size = high - low
    level = np.frompyfunc(int.bit_length, 1, 1)(size).astype(np.int64) - 1 if len(size) else np.empty(0, np.int64)
    out = np.empty(len(size), np.uint8)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][low[own] + 1], table[k][high[own] - (1 << int(k)) + 1])
    return out


def repeated_windows(group: np.ndarray, rank: np.ndarray, before: np.ndarray, n_before: np.ndarray,
                     after: np.ndarray, n_after: np.ndarray, length: int) -> np.ndarray:
    """Which windows start earlier in another member: ``out[member, a]`` for the window ``a`` bytes before the anchor.

    ``before[i, k]`` is the byte ``k + 1`` places before the anchor, ``after[i]`` the bytes from the anchor
    on (zero-filled; true lengths beside them).  ``group`` numbers the anchors, ``rank`` the members by (document, position).
    """
    n, levels = len(group), before.shape[1] + 1
    out = np.zeros((n, levels), bool)
    # Suffix order from the anchor on, and the common prefixes of neighbours.
    words = np.zeros((n, -(-after.shape[1] // 8) * 8), np.uint8)
    words[:, :after.shape[1]] = after
    columns = words.view(">u8").astype(np.uint64)
    order = np.lexsort([n_after, *columns.T[::-1], group])
    equal = after[order[1:]] == after[order[:-1]]
    prefix = np.where(equal.all(1), after.shape[1], equal.argmin(1)) if after.shape[1] else np.zeros(n - 1, np.int64)
    prefix = np.minimum(prefix, np.minimum(n_after[order[1:]], n_after[order[:-1]]))
    prefix[group[order[1:]] != group[order[:-1]]] = 0
    table = [np.concatenate([[0], prefix]).astype(np.uint8)]
    while len(table[-1]) > 1 << (len(table) - 1):
        step = 1 << (len(table) - 1)
        last = table[-1]
        table.append(np.minimum(last, np.concatenate([last[step:], np.full(step, 255, np.uint8)])[:len(last)]))
    # Members of the open intervals, in suffix order; ``interval`` numbers their intervals.
    at = np.arange(n)
    interval = group[order]
    for a in range(levels):
        if a:
            member = order[at]
            going = n_before[member] >= a
            at, interval, member = at[going], interval[going], member[going]
            split = interval.astype(np.int64) * 256 + before[member, a - 1]
            turn = np.argsort(split, kind="stable")
            at, split = at[turn], split[turn]
            interval = np.cumsum(np.concatenate([[0], split[1:] != split[:-1]])) if len(split) else split
        near = np.flatnonzero(interval[1:] == interval[:-1])
        if not len(near):
            return out
        shared = _common(table, at[near], at[near + 1])
        joined = np.zeros(len(at), bool)  # with the member before it
        joined[near + 1] = shared >= length - a
        if joined.any():
            starts = np.flatnonzero(~joined)
            members = order[at]
            first = np.minimum.reduceat(rank[members], starts)
            sizes = np.diff(np.append(starts, len(at)))
            out[members, a] = rank[members] != np.repeat(first, sizes)
        # Only members whose neighbours can still reach the length stay open.
        hope = np.zeros(len(at), bool)
        reach = near[shared.astype(np.int64) + levels - 1 >= length]
        hope[reach] = hope[reach + 1] = True
        at, interval = at[hope], interval[hope]
    return out


def _chunk_spans(rows: list[dict], length: int, gram: int) -> pa.RecordBatch:
    """Runs of repeated windows of whole anchors: ``doc_id, start, end`` in bytes."""
    reach = length - gram
    n = len(rows)
    before, after = np.zeros((n, reach), np.uint8), np.zeros((n, length), np.uint8)
    n_before, n_after = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, row in enumerate(rows):
        left, right = row["before"], row["after"]
        n_before[i], n_after[i] = len(left), len(right)
        before[i, :len(left)] = np.frombuffer(left, np.uint8)[::-1]
        after[i, :len(right)] = np.frombuffer(right, np.uint8)
    doc, pos = np.array([r["doc_id"] for r in rows], np.int64), np.array([r["pos"] for r in rows], np.int64)
    keys = np.array([r["anchor"] for r in rows], np.int64)
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    rank = np.empty(n, np.int64)
    rank[np.lexsort((pos, doc))] = np.arange(n)
    found = repeated_windows(group, rank, before, n_before, after, n_after, length)
    flat = np.zeros((n, found.shape[1] + 1), bool)
    flat[:, :-1] = found
    first, end = runs(flat.ravel())
    member, low = np.divmod(first, flat.shape[1])
    high = low + (end - first) - 1  # levels low..high repeat: starts pos - high .. pos - low
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[member], pa.int64()), pa.array(pos[member] - high, pa.int64()),
         pa.array(pos[member] - low + length, pa.int64())], names=["doc_id", "start", "end"])


def interval_spans(contexts: DataFrame, length: int, gram: int, parts: int, limit: int) -> DataFrame:
    """``doc_id, start, end`` of repeated windows among ``contexts(anchor, doc_id, pos, before, after)``."""
    sizes = contexts.groupBy("anchor").count().filter(F.col("count") > limit).select("anchor")
    large = stage(sizes, "suffix-large")
    small = contexts.join(large, "anchor", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= 20_000 and row["anchor"] != held[-1]["anchor"]:
                    yield _chunk_spans(held, length, gram)
                    held = []
                held.append(row)
        if held:
            yield _chunk_spans(held, length, gram)

    found = (small.repartition(parts, "anchor").sortWithinPartitions("anchor")
             .mapInArrow(run, "doc_id bigint, start bigint, end bigint"))
    if large.isEmpty():
        return found
    # Windows of the large anchors, by hash: the earliest stays.
    hot = contexts.join(large, "anchor", "left_semi")
    starts = F.sequence(F.lit(0), F.octet_length("before").cast("int"))
    windows = (hot.select("doc_id", "pos", F.octet_length("before").alias("_left"),
                          F.concat("before", "after").alias("_all"), F.explode(starts).alias("a"))
               .withColumn("_window", F.expr(f"substring(_all, _left - a + 1, {length})"))
               .filter(F.octet_length("_window") == length)
               .select("doc_id", (F.col("pos") - F.col("a")).alias("start"), F.xxhash64("_window").alias("h1"),
                       F.xxhash64(F.lit(13), "_window").alias("h2")))
    windows = stage(windows, "suffix-large-windows")
    firsts = stage(windows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("first"),
                                                   F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "suffix-large-firsts")
    later = windows.join(firsts, ["h1", "h2"]).filter(F.struct("doc_id", "start") != F.col("first"))
    return found.unionByName(later.select("doc_id", "start", (F.col("start") + length).alias("end")))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False,
                 group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs(doc_id, text)``.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it also starts
    earlier (smaller ``doc_id``, or same document and earlier start).  ``kept`` has the
    other bytes (binary: a cut may split a character), or with ``digest`` their SHA-256.  Null or
    empty text: no bytes.  Of rows that share a ``doc_id`` one takes part (see
    ``packed.distinct_documents``); the others, and rows without an id, lose nothing.  Other columns are not read.
    """
    if not 1 < gram <= length // 2 or length > 250:
        raise ValueError("needs 1 < gram <= length / 2 and length <= 250")
    reach = length - gram

    def finish(text: str | None, spans: list[tuple[int, int]]) -> tuple:
        raw = (text or "").encode()
        gone = _cover(spans, len(raw)) if spans else np.zeros(len(raw), bool)
        kept = raw if not spans else np.frombuffer(raw, np.uint8)[~gone].tobytes()
        return len(raw), int(gone.sum()), len(runs(gone)[0]) if spans else 0, hashlib.sha256(kept).hexdigest().encode() if digest else kept

    def first_pass(batches):
        """Documents without mixed anchors are done; of the others the spans known so far."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                done, texts, spans, mixed = [], [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist(), strict=True):
                    codes = np.frombuffer(found or b"", "<i4").astype(np.int64)
                    known = _full_spans(codes, len((text or "").encode()), length, gram) if len(codes) else codes
                    open_at = codes[codes % 2 == MIXED] // 2
                    if len(open_at):
                        done.append((None, None, None, None))
                        texts.append(text)
                        spans.append(known.astype("<i4").tobytes())
                        mixed.append(open_at.astype("<i4").tobytes())
                    else:
                        done.append(finish(text, known.tolist()))
                        texts.append(None)
                        spans.append(None)
                        mixed.append(None)
                yield _rows(part, done, text=pa.array(texts, pa.string()), spans=pa.array(spans, pa.binary()),
                            mixed=pa.array(mixed, pa.binary()))

    def contexts_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                keys, docs_, places, before, after = [], [], [], [], []
                for doc, text, mixed in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "mixed")), strict=True):
                    raw = text.encode()
                    where = np.frombuffer(mixed, "<i4").astype(np.int64)
                    hashes = SpanHasher(np.frombuffer(raw, np.uint8)).spans(where, where + gram)
                    keys.extend(hashes.view(np.int64).tolist())
                    docs_.extend([doc] * len(where))
                    places.extend(where.tolist())
                    before.extend(raw[max(0, p - reach):p] for p in where.tolist())
                    after.extend(raw[p:p + length] for p in where.tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(docs_, pa.int64()), pa.array(places, pa.int64()),
                     pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                    names=["anchor", "doc_id", "pos", "before", "after"])

    def second_pass(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                done = []
                for text, known, more in zip(*(part.column(c).to_pylist() for c in ("text", "spans", "more")), strict=True):
                    spans = np.frombuffer(known, "<i4").reshape(-1, 2).tolist() + [(m["start"], m["end"]) for m in more or []]
                    done.append(finish(text, spans))
                yield _rows(part, done)

    result = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    own, rest = packed.distinct_documents(docs.select("doc_id", "text"))
    parts = packed.exchange_parts(own)
    hits = packed.exchange(own, _emit_anchors(length, gram), _judge_anchors, ENTRY, parts)
    marked = own.join(hits, "doc_id", "left").unionByName(rest.withColumn("found", F.lit(None).cast("binary")))
    first = stage(marked.select("doc_id", "text", "found").mapInArrow(
        first_pass, f"{result}, text string, spans binary, mixed binary"), "suffix-anchors")
    involved = first.filter("mixed IS NOT NULL")
    contexts = stage(involved.select("doc_id", "text", "mixed").mapInArrow(
        contexts_of, "anchor bigint, doc_id bigint, pos bigint, before binary, after binary"), "suffix-contexts")
    spans = interval_spans(contexts, length, gram, parts, group_limit)
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    second = (involved.select("doc_id", "text", "spans").join(by_doc, "doc_id", "left")
              .select("text", "spans", "more", "doc_id").mapInArrow(second_pass, result))
    return first.filter("mixed IS NULL").select(*names).unionByName(second)


def _rows(part: pa.RecordBatch, done: list[tuple], **more: pa.Array) -> pa.RecordBatch:
    n, gone, spans, kept = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
         pa.array(kept, pa.binary()), *more.values()],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *more])


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Byte-level repeats of 100 bytes removed from the whole ``documents`` table, digested per document."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return suffix_dedup(docs, digest=True).withColumn("kept", F.col("kept").cast("string")).withColumnRenamed("kept", "kept_sha256")
