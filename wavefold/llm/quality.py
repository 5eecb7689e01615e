"""Quality rules with host verdicts.

Every text is measured once: words, symbols, repeated lines, repeated word windows.
A host's rule failures are counted, its failure rate is shrunk towards the rate of
all hosts by an empirical beta prior, and the host's verdict is joined back to its
documents.  A host is *trusted* if its posterior leaves no more than about five percent to rates
above the prior's mean: it fails less often than hosts do, and a breach there is taken for a false
alarm.  On every other host, small ones included, a document that breaks a rule goes.  A document that breaks
no rule stays on every host.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavefold.llm.common import SpanHasher, line_spans, mix, rolling, stage, text_chunks, unused, word_spans

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PERCENT = 30
TRUST_Z = 1.645  # normal bound of a five percent tail

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each item: how it sorts among equal items of one owner: 0 alone, 1 first, 2 later."""
    keys = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    kind = np.zeros(len(keys), np.int8)
    kind[order] = np.where(same[:-1], 2, np.where(same[1:], 1, 0))
    return kind


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text of an Arrow string column."""
    out = {name: np.zeros(len(column), np.int64) for name in MEASURES}
    for first, end, data, offsets in text_chunks(column):
        n = end - first
        start, stop, owner = word_spans(data, offsets)
        hasher = SpanHasher(data)
        out["n_words"][first:end] = np.bincount(owner, minlength=n)
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        out["word_chars"][first:end] = np.bincount(owner, letters[stop] - letters[start], n)
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
        out["n_symbols"][first:end] = np.diff(symbols[offsets])

        if len(start) >= 3:
            grams = rolling(hasher.spans(start, stop), 3)
            inside = np.flatnonzero(owner[:-2] == owner[2:])
            found = inside[_repeated(owner[inside], grams[inside]) > 0]
            covered = np.zeros(len(start), bool)
            for k in range(3):
                covered[found + k] = True
            out["n_repeat_words"][first:end] = np.bincount(owner[covered], minlength=n)

        line_start, line_end, line_owner = line_spans(data, offsets)
        words_before = np.searchsorted(start, np.stack([line_start, line_end]))
        worded = np.flatnonzero(words_before[1] > words_before[0])
        line_hash = hasher.spans(line_start[worded], line_end[worded])
        later = _repeated(line_owner[worded], line_hash) == 2
        out["n_dup_lines"][first:end] = np.bincount(line_owner[worded[later]], minlength=n)
        out["n_text_lines"][first:end] = np.bincount(line_owner[worded], minlength=n)
    return out


def measured(docs: DataFrame, column: str = "_q") -> DataFrame:
    """``docs`` plus a struct ``column`` of the measures of ``text`` (null: none)."""
    base = docs.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column("text"))
            struct = pa.StructArray.from_arrays([pa.array(found[m]) for m in MEASURES], MEASURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, column])

    kind = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(column, kind)]))


def base_failed(q: str = "_q"):
    words, repeats = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def rule_failed(q: str = "_q"):
    """Symbols and repeated lines, beside the base rules."""
    return ((100 * F.col(f"{q}.n_symbols") > MAX_SYMBOLS_PER_100_WORDS * F.col(f"{q}.n_words"))
            | (100 * F.col(f"{q}.n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col(f"{q}.n_text_lines")))


def host_verdicts(flags: DataFrame) -> DataFrame:
    """``host, n_docs, n_failed, rate, strict`` from ``flags(host, failed)``.

    The beta prior is fitted to the hosts' raw rates by moments: with mean ``m`` and variance
    ``v`` its weight is ``m (1 - m) / v - 1``, kept between 2 and 1000; without
    spread it is 1000.  The shrunk rate ``r = (failed + m w) / (docs + w)`` is the posterior's mean, its
    deviation ``s = sqrt(r (1 - r) / (docs + w + 1))``; a host is strict unless ``r + 1.645 s <= m``.
    Without any failure no host is strict; a single host that has some is.
    """
    hosts = flags.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = stage(hosts, "quality-hosts")
    raw = F.col("n_failed") / F.col("n_docs")
    spread = hosts.agg(F.avg(raw).alias("m"), (F.avg(raw * raw) - F.avg(raw) * F.avg(raw)).alias("v")).first()
    mean = spread["m"] or 0.0
    variance = spread["v"] or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance > 1e-12 else 1000.0
    weight = min(1000.0, max(2.0, weight))
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n_docs") + F.lit(weight + 1)))
    strict = F.col("rate") + TRUST_Z * deviation > F.lit(mean)
    return stage(hosts.withColumn("rate", rate).withColumn("strict", strict), "quality-verdicts")


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` plus a struct ``_q`` of the measures, ``base_failed`` and ``kept``.

    ``kept`` is false for a document that fails a base rule, or breaks another
    rule on a strict host.  A null host is a host of its own; null text has no words and
    fails.  Rows that repeat are judged one by one; an empty table gives an empty result.  The
    texts are measured twice (for the hosts, for the documents) and never shuffled.
    Columns named like the three results are replaced; all others stay.
    """
    named = F.coalesce(F.col(host), F.lit(""))
    flags = measured(docs.select(named.alias("host"), "text"))
    verdicts = host_verdicts(flags.select("host", (base_failed() | rule_failed()).alias("failed")))
    base = docs.drop("base_failed", "kept", "_q")
    known, strict = unused(base, "_host", "_strict")
    joined = measured(base).join(verdicts.select(F.col("host").alias(known), F.col("strict").alias(strict)),
                                 named == F.col(known), "left")
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~(rule_failed() & F.coalesce(strict, F.lit(False))))
            .select(*base.columns, "_q", "base_failed", "kept"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Quality rules over every row of ``documents``, with host verdicts by ``source``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", *[F.col(f"_q.{m}").alias(m) for m in MEASURES[:5]], "base_failed", "kept")


ORACLE = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS a FROM tokens),
grams AS (
  SELECT x.doc_id, x.i, x.a || ' ' || y.a || ' ' || z.a AS g
  FROM words x JOIN words y ON y.doc_id = x.doc_id AND y.i = x.i + 1
  JOIN words z ON z.doc_id = x.doc_id AND z.i = x.i + 2),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
hit AS (SELECT g.doc_id, g.i FROM grams g JOIN twice t ON t.doc_id = g.doc_id AND t.g = g.g),
repeated AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, i + k AS i FROM hit, (VALUES (0), (1), (2)) v(k)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM tokens),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
  SELECT t.doc_id, t.host, len(t.w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(t.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n_lines, 0) AS n_text_lines
  FROM tokens t LEFT JOIN repeated r USING (doc_id) LEFT JOIN line_counts l USING (doc_id)),
flagged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_text_lines AS rule_failed
  FROM measured),
hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed OR rule_failed) AS f FROM flagged GROUP BY host),
moments AS (SELECT avg(f / n) AS m, avg((f / n) * (f / n)) - avg(f / n) * avg(f / n) AS v FROM hosts),
prior AS (
  SELECT m, CASE WHEN v > 1e-12 THEN least(1000.0::DOUBLE, greatest(2.0::DOUBLE, m * (1 - m) / v - 1)) ELSE 1000.0::DOUBLE END AS w
  FROM moments),
rates AS (SELECT host, (f + m * w) / (n + w) AS r, n + w + 1 AS weight, m FROM hosts, prior),
verdicts AS (SELECT host, r + 1.645::DOUBLE * sqrt(r * (1 - r) / weight) > m AS strict FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rule_failed AND strict) AS kept
FROM flagged JOIN verdicts USING (host)
"""
