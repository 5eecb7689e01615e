"""N-gram Jaccard join over a prefix tree of globally ordered shingle sets.

Each text is the set of its word n-grams, ordered rare first: by the level of a corpus-wide count sketch
(fixed size, all documents), then by hash.  Any fixed order gives the same result; this one puts
what many documents share at the end.

A set whose similarity with another reaches the threshold shares the first elements of its prefix with
it, so the prefixes are the first steps of the tree.  They are a twentieth of the set longer than the shortest that
would do, so that linked sets share that many elements in them.  A packed exchange finds the prefix
elements that two sets share; only documents with enough of them go on, which a common line or passage alone does not give.

Pairs are then met in rounds.  Round one links each set to a hub among the sets with an equal
smallest hash.  Hub rounds follow as long as they join components: of the sets with a shared prefix element, one member of each component
meets one of the largest, drawn anew each time.  Most near copies join a component there, in linear work.  The last round walks
all shared prefix elements, but only between different components and within
the length bounds, so a group of thousands of near copies never spreads into all its pairs, and no link
between components is lost.

Pairs are verified by a traversal: the sets that meet one set are sorted into their prefix tree, the overlap
along a shared path is counted once, and a subtree is left as soon as the remaining lengths
cannot reach the needed overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm import packed
from wavefold.llm.common import SpanHasher, components, mix, rolling, stage, text_chunks, word_spans

WORDS = 5
PERCENT = 80
SKETCH_BITS = 20
SLICES = 64
HUB_HASHES = 4
HUB_ROUNDS, HUB_YIELD = 16, 50
HUB_BAND = 0.22
_HASH = np.uint64((1 << 58) - 1)
SMALL = np.dtype(np.uint32)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of every text; fewer words than ``size`` make one shingle."""
    for first, end, data, offsets in text_chunks(column):
        start, stop, owner = word_spans(data, offsets)
        hashes = SpanHasher(data, lower=True).spans(start, stop)
        grams = rolling(hashes, size)
        bounds = np.searchsorted(owner, np.arange(end - first + 1))
        for n, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b - a >= size:
                yield first + n, np.unique(grams[a:b - size + 1])
            elif b > a:
                yield first + n, rolling(hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield first + n, np.empty(0, np.uint64)


def needed(n: int, percent: int) -> int:
    """Smallest overlap of a set of ``n`` with any set it is linked to."""
    return -(-percent * n // 100)


def slack(n: int) -> int:
    """Elements that a prefix holds beyond the shortest one, so that a linked set shares this many in it."""
    return max(1, n // 20)


def _enough(found, n, percent: int):
    """Whether a set of ``n`` shares as many prefix elements as a link to the smallest possible set would bring."""
    smallest = F.ceil(F.lit(percent) * n / 100)
    return F.octet_length(found) / 4 >= F.greatest(F.lit(1), F.floor(smallest / 20))


def _measure(docs: DataFrame, size: int) -> DataFrame:
    """Per document its set's size and fingerprint; per task the slices of its count sketch."""
    each = (1 << SKETCH_BITS) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, one, two, buckets = [], [], [], []
                for _, found in shingle_sets(part.column("text"), size):
                    sizes.append(len(found))
                    one.append(mix(found + np.uint64(1)).sum(dtype=np.uint64))
                    two.append(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    buckets.append(found >> np.uint64(64 - SKETCH_BITS))
                if buckets:
                    counts += np.bincount(np.concatenate(buckets).astype(np.int64), minlength=1 << SKETCH_BITS)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)),
                     pa.array(np.array(two, np.uint64).view(np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=["doc_id", "n_shingles", "s1", "s2", "slice", "counts"])
        slices = [counts[k * each:(k + 1) * each].tobytes() for k in range(SLICES)]
        none = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(slices, pa.binary())],
            names=["doc_id", "n_shingles", "s1", "s2", "slice", "counts"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, slice int, counts binary")


def _levels(measured: DataFrame) -> np.ndarray:
    """Level of each sketch bucket (one byte each: ``2 ** SKETCH_BITS`` bytes reach the driver)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["slice", "counts"])

    rows = measured.filter("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
    found = {r["slice"]: np.frombuffer(r["counts"], np.int64) for r in rows.mapInArrow(add, "slice int, counts binary").collect()}
    each = (1 << SKETCH_BITS) // SLICES
    counts = np.concatenate([found.get(k, np.zeros(each, np.int64)) for k in range(SLICES)])
    return np.minimum(63, 2 * np.log2(counts + 1)).astype(np.uint8)


def ordered(found: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Element numbers in the global order: level, then hash."""
    level = levels[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(58)) | (found >> np.uint64(6)))


def _emit_prefixes(size: int, percent: int, levels: np.ndarray):
    def emit(batches, parts):
        for turn, batch in enumerate(packed.flushes(batches)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            rows, places, keys = [], [], []
            for row, found in shingle_sets(batch.column("text"), size):
                if len(found):
                    prefix = min(len(found), len(found) - needed(len(found), percent) + slack(len(found)))
                    rows.append(np.full(prefix, row))
                    places.append(np.arange(prefix))
                    keys.append(ordered(found, levels)[:prefix])
            if not rows:
                continue
            doc, pos = ids[np.concatenate(rows)], np.concatenate(places)
            key = mix(np.concatenate(keys))
            by_doc = np.lexsort((pos, doc))
            doc, pos, key = doc[by_doc], pos[by_doc], key[by_doc]
            known, lead = _shared(key)
            out = packed.settled(doc[known], pos[known], parts, turn)
            going = ~known | lead  # one entry of a key that is settled here
            out += [(part, -1, packed.pack(d, p, k)) for part, (d, p, k) in packed.split_parts(
                packed.part_of(key[going], parts), doc[going], pos[going], key[going].astype(np.uint32))]
            yield out
    return emit


def _shared(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a key that occurs twice or more, and which come first of theirs."""
    order = np.argsort(keys, kind="stable")
    same = np.concatenate([[False], keys[order][1:] == keys[order][:-1], [False]])
    known, lead = np.empty(len(keys), bool), np.empty(len(keys), bool)
    known[order] = same[1:] | same[:-1]
    lead[order] = ~same[:-1]
    return known, lead


def _judge_prefixes(doc, pos, keys):
    known, _ = _shared(keys)
    return doc[known], pos[known]


def _as_sets(involved: DataFrame, size: int, levels: np.ndarray) -> DataFrame:
    """``doc_id, n, elements`` (big-endian, so bytes sort like sets), ``shared`` and ``smallest`` elements."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hits = part.column("found").to_pylist()
                counts, sets, shared, smallest = [], [], [], []
                for row, found in shingle_sets(part.column("text"), size):
                    elements = ordered(found, levels)
                    where = np.frombuffer(hits[row], "<i4")
                    counts.append(len(elements))
                    sets.append(elements.astype(">u8").tobytes())
                    shared.append([{"key": k, "pos": p} for k, p in zip(elements[where].view(np.int64).tolist(), where.tolist(), strict=True)])
                    smallest.append(np.sort(elements & _HASH)[:HUB_HASHES].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int32()), pa.array(sets, pa.binary()),
                     pa.array(shared, pa.list_(pa.struct([("key", pa.int64()), ("pos", pa.int32())]))),
                     pa.array(smallest, pa.list_(pa.int64()))], names=["doc_id", "n", "elements", "shared", "smallest"])

    return involved.mapInArrow(
        run, "doc_id bigint, n int, elements binary, shared array<struct<key:bigint,pos:int>>, smallest array<bigint>")


def overlaps(root: np.ndarray, others: list[bytes], percent: int, step: int = 128) -> list[int]:
    """Overlap of ``root`` with each of ``others``; -1 where a bound showed that it is too small for a link.

    The sets are visited in tree order, so neighbours share the count along their common path.
    """
    out = [-1] * len(others)
    path, count = np.empty(0, np.uint64), np.zeros(1, np.int64)  # overlap after each depth of the present path
    for i in sorted(range(len(others)), key=others.__getitem__):
        own = np.frombuffer(others[i], ">u8").astype(np.uint64)
        need = -(-percent * (len(root) + len(own)) // (100 + percent))
        m = min(len(path), len(own))
        differ = np.flatnonzero(path[:m] != own[:m])
        depth = min(int(differ[0]) if len(differ) else m, len(count) - 1)
        count = count[:depth + 1]
        while depth < len(own):
            used = int(np.searchsorted(root, own[depth]))
            if count[-1] + min(len(own) - depth, len(root) - used) < need:
                break
            piece = own[depth:depth + step]
            at = np.minimum(np.searchsorted(root, piece), max(0, len(root) - 1))
            hits = root[at] == piece if len(root) else np.zeros(len(piece), bool)
            count = np.concatenate([count, count[-1] + np.cumsum(hits)])
            depth += len(piece)
        else:
            if count[-1] >= need:
                out[i] = int(count[-1])
        path = own
    return out


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs(a, b)``."""
    held = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, held):
                part = batch.slice(at, held)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                left, right = part.column("left").to_pylist(), part.column("right").to_pylist()
                groups: dict[int, list[int]] = {}
                for i, root in enumerate(a):
                    groups.setdefault(root, []).append(i)
                good = []
                for members in groups.values():
                    root = np.frombuffer(left[members[0]], ">u8").astype(np.uint64)
                    found = overlaps(root, [right[i] for i in members], percent)
                    good += [i for i, n in zip(members, found, strict=True) if n >= 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])

    other = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("right"))
    root = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("left"))
    return pairs.join(other, "b").join(root, "a").select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _contracted(met: DataFrame, links: DataFrame) -> DataFrame:
    """``met(id, component)`` after the components that ``links(a, b)`` join have become one."""
    of = lambda side, c: met.select(F.col("id").alias(side), F.col("component").alias(c))
    edges = (links.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left")
             .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    over = components(met.sparkSession, edges, "ngram-contracted").select(F.col("id").alias("component"), F.col("component").alias("now"))
    ends = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    fresh = ends.join(met, "id", "left_anti").withColumn("component", F.col("id"))
    return stage(met.unionByName(fresh).join(over, "component", "left").select("id", F.coalesce("now", "component").alias("component")),
                 "ngram-near")


def _reachable(na, pa_, nb, pb, percent: int):
    """Whether sets of ``na`` and ``nb`` elements that meet at these positions can still share enough from there on."""
    return (100 + percent) * F.least(na - pa_, nb - pb) >= percent * (na + nb)


def _placed(posts: DataFrame, met: DataFrame) -> DataFrame:
    """``posts(doc_id, n, key, pos)`` with components, of the keys that occur in several."""
    placed = stage(posts.join(met.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                   .withColumn("component", F.coalesce("component", "doc_id")), "ngram-posts")
    crossed = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .filter("low < high").select("key"))
    return stage(placed.join(crossed, "key", "left_semi"), "ngram-open")


def _hub_rounds(posts: DataFrame, sets: DataFrame, met: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``met`` and the posts left open after hub rounds.

    Of every key, each component sends one member of a band of sizes to one of the largest component there.  The members are drawn by another hash each
    time and no pair is tried twice.  It ends once less than one pair in ``HUB_YIELD`` is linked; what is still apart is left to the exact round.
    """
    tried = None
    for turn in range(HUB_ROUNDS):
        posts = _placed(posts, met)
        draw = F.xxhash64(F.lit(turn), "key", "doc_id")
        drawn = F.min_by(F.struct("doc_id", "n", "pos"), draw).alias("one")
        band = F.floor(F.log("n") / HUB_BAND + turn * 0.38).cast("int").alias("band")  # sets that differ more are not linked; borders move
        members = stage(posts.groupBy("key", band, "component").agg(drawn, F.count(F.lit(1)).alias("size"), F.min(draw).alias("draw")),
                        "ngram-members")
        hubs = members.groupBy("key", "band").agg(F.max(F.struct("size", "draw", "component", "one")).alias("hub"))
        met_at = _reachable(F.col("one.n"), F.col("one.pos"), F.col("hub.one.n"), F.col("hub.one.pos"), percent)
        pairs = members.join(hubs, ["key", "band"]).filter((F.col("component") != F.col("hub.component")) & met_at).select(
            F.least("one.doc_id", "hub.one.doc_id").alias("a"), F.greatest("one.doc_id", "hub.one.doc_id").alias("b")).distinct()
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
        links = stage(verify(pairs, sets, percent), "ngram-links")
        found = links.count()
        posts = posts.drop("component")
        if found:
            met = _contracted(met, links)
        if found * HUB_YIELD <= pairs.count():
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
    return met, _placed(posts, met)


def ngram_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    Two documents are linked when the intersection of their sets of ``size``-word shingles (A-Z
    lower-cased) has at least ``percent`` % of the size of the union; ``component_id`` is the smallest id reachable by links.
    A text with fewer words is one shingle; null, empty and wordless texts have no shingles and no
    links.  Of rows that share a ``doc_id`` one takes part (see ``packed.distinct_documents``); the others, and
    rows without an id, are linked with nothing.  Equal sets count as one set.  Other columns are not read.
    """
    own, rest = packed.distinct_documents(docs.select("doc_id", "text"))
    measured = stage(_measure(own, size), "ngram-measures")
    levels = _levels(measured)
    known = measured.filter("slice IS NULL").select("doc_id", "n_shingles", "s1", "s2")
    classes = stage(known.filter("n_shingles > 0").groupBy("n_shingles", "s1", "s2")
                    .agg(F.min("doc_id").alias("class_id")), "ngram-classes")

    parts = packed.exchange_parts(own)
    hits = packed.exchange(own, _emit_prefixes(size, percent, levels), _judge_prefixes, SMALL, parts)
    hits = hits.join(classes.select(F.col("class_id").alias("doc_id"), "n_shingles"), "doc_id")
    hits = hits.filter(_enough(F.col("found"), F.col("n_shingles"), percent)).drop("n_shingles")
    involved = own.join(hits, "doc_id").select("doc_id", "text", "found")
    sets = stage(_as_sets(involved, size, levels), "ngram-sets")

    # Round one: hubs among equal smallest hashes.
    near = sets.select("doc_id", F.explode("smallest").alias("key"))
    hubs = stage(near.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("key", "hub"), "ngram-hubs")
    first = near.join(hubs, "key").filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    first = stage(verify(first, sets, percent), "ngram-links")
    met = components(docs.sparkSession, first, "ngram-first")

    # Hub rounds, then shared prefix elements between the components left.
    posts = sets.select("doc_id", "n", F.explode("shared").alias("e")).select("doc_id", "n", "e.key", "e.pos")
    met, open_posts = _hub_rounds(posts, sets, met, percent)
    x = open_posts.select("key", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("component").alias("ca"))
    y = open_posts.select("key", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("cb"))
    reachable = _reachable(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent)
    candidates = (x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & reachable)
                  .select("a", "b").distinct())
    second = stage(verify(candidates, sets, percent), "ngram-links")

    merged = second.join(met.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left") \
        .join(met.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left") \
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = components(docs.sparkSession, merged, "ngram-second")
    of_class = (classes.join(met.withColumnRenamed("id", "class_id"), "class_id", "left")
                .withColumn("near", F.coalesce("component", "class_id")).drop("component")
                .join(joined.withColumnRenamed("id", "near"), "near", "left")
                .select("n_shingles", "s1", "s2", F.coalesce("component", "near").alias("component_id")))
    of_class = stage(of_class, "ngram-components")
    result = known.join(of_class, ["n_shingles", "s1", "s2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = _measure(rest, size).filter("slice IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.unionByName(alone)


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Components of the 5-word-shingle Jaccard join over the whole ``documents`` table."""
    return ngram_components(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
