"""Line deduplication across documents with levelled sorted runs of line hashes.

Documents arrive in batches of ascending ``doc_id``.  A *run* is a table of
128-bit line hashes with the document that first held the line, sorted by hash
inside hash partitions.  Every batch is merge-joined with the runs: hashes without a
partner are new and become a run of level 0 (the anti-join), hashes with one
belong to an earlier document.  When a level holds ``fanout`` runs they are merged into
one run of the next level, so a batch meets few runs and each hash is rewritten
a logarithmic number of times.

Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import WHITE, ascii_lower, stage, unused

MIN_KEY_CHARS = 10
BATCHES = 4
FANOUT = 2


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that takes part: ``doc_id, row_key, pos, h1, h2``."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.filter("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64(text).alias("row_key"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "row_key", "pos", ascii_lower(F.btrim("line", F.lit(WHITE))).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class LineRuns:
    """The levelled runs: ``levels[n]`` holds the runs of level ``n``."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def merge(self, batch: DataFrame) -> DataFrame:
        """Merge ``batch(h1, h2, owner, last)`` with every run and add what is new.

        Returns the batch's keys that more than one document holds, with the smallest one (``h1, h2, owner``).
        """
        merged, holders = batch, []
        for k, run in enumerate(r for level in self.levels for r in level):
            seen = run.select("h1", "h2", F.col("owner").alias(f"run{k}"))
            merged = merged.hint("merge").join(seen, ["h1", "h2"], "left")
            holders.append(f"run{k}")
        earlier = F.coalesce(*[F.col(c) for c in holders]) if holders else F.lit(None).cast("long")
        keys = stage(merged.select("h1", "h2", F.coalesce(earlier, "owner").alias("owner"),
                                   earlier.isNull().alias("new"),
                                   (earlier.isNotNull() | (F.col("owner") < F.col("last"))).alias("shared")
                                   ).sortWithinPartitions("h1", "h2"), "line-run")
        self._add(0, keys.filter("new").select("h1", "h2", "owner"))
        return keys.filter("shared").select("h1", "h2", "owner")

    def _add(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return
        both = self.levels[level][0]
        for other in self.levels[level][1:]:
            both = both.union(other)
        self.levels[level] = []
        compacted = stage(both.repartition("h1", "h2").sortWithinPartitions("h1", "h2"), f"line-run-l{level + 1}")
        self._add(level + 1, compacted)


def _batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """Consecutive ``doc_id`` ranges of about equal counts; the ranges prune the scan."""
    cuts = [i / batches for i in range(1, batches)]
    known = docs.filter("doc_id IS NOT NULL")
    found = known.approxQuantile("doc_id", cuts, 0.01) if cuts else []
    bounds = sorted({int(x) for x in found})
    if not bounds:
        return [known]
    parts = [known.filter(F.col("doc_id") < bounds[0])]
    parts += [known.filter((F.col("doc_id") >= a) & (F.col("doc_id") < b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [*parts, known.filter(F.col("doc_id") >= bounds[-1])]


def shared_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Hashes held by at least two documents, with the smallest ``doc_id``: ``h1, h2, owner``."""
    state, found = LineRuns(fanout), None
    for part in _batches(docs, batches):
        keys = (_lines(part, min_chars).groupBy("h1", "h2")
                .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")))
        shared = state.merge(keys)
        found = shared if found is None else found.union(shared)
    return stage(found.distinct(), "shared-lines")


def line_dedup(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with shared lines removed, plus ``kept_text, n_lines, n_dropped``.

    A line's key is the line stripped of white space with A-Z lower-cased.  A key of at
    least ``min_chars`` code points in two or more documents stays in the smallest
    ``doc_id`` (all its lines there) and goes elsewhere.  Null or empty text: one empty
    line, nothing dropped.  A null ``doc_id`` neither holds nor loses lines.  Rows
    that repeat a ``doc_id`` count as one document.  Columns of ``docs`` named like the
    three results are replaced; all others stay.
    """
    owners = shared_lines(docs, min_chars, batches, fanout)
    base = docs.drop("kept_text", "n_lines", "n_dropped")
    doc, key, drop, parts, text_key = unused(base, "_doc", "_key", "_drop", "_lines", "_text_key")
    drops = (_lines(docs, min_chars).join(owners, ["h1", "h2"]).filter(F.col("doc_id") > F.col("owner"))
             .groupBy(F.col("doc_id").alias(doc), F.col("row_key").alias(key))
             .agg(F.collect_set("pos").alias(drop)))
    text = F.coalesce("text", F.lit(""))
    keyed = base.withColumn(text_key, F.xxhash64(text))
    joined = keyed.join(drops, (F.col("doc_id") == F.col(doc)) & (F.col(text_key) == F.col(key)), "left")
    lines = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    kept = F.array_join(F.transform(stay, lambda p: F.get(F.col(parts), p)), "\n")
    return (joined.withColumn(parts, lines)
            .withColumn("kept_text", F.when(F.col(drop).isNull(), text).otherwise(kept))
            .withColumn("n_lines", F.size(parts).cast("long"))
            .withColumn("n_dropped", F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long"))
            .select(*base.columns, "kept_text", "n_lines", "n_dropped"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line deduplication of the whole ``documents`` table, digested per document."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.pos, k.line, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN owners o ON o.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
