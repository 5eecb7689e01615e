"""Incremental conversion planning: fingerprints, currency, status counters.

An output is current only when every field of its recorded fingerprint equals
the expected one (null-safe).  Sources are identified by name, size and
modification time, never by a content hash, so a plan over an archive of any
size reads listings and small records only.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: bumped only when the converted content itself changes.
CONVERSION_FORMAT_VERSION = 1
FINGERPRINT_FIELDS = (
    "source_name", "source_size", "source_mtime_ns", "layout_sha256", "columns",
    "all_string", "output_format", "conversion_format_version",
)


def columns_token(columns: Iterable[str] | None) -> Column:
    """Sorted lower-case column request joined by commas; null means 'all'."""
    if columns is None:
        return F.lit(None).cast("string")
    return F.lit(",".join(sorted(c.lower() for c in columns)))


def expected_fingerprint(
    sources: DataFrame, columns: Iterable[str] | None, all_string: bool, output_format: str,
) -> DataFrame:
    """``sources``: source_name, source_size, source_mtime_ns, layout_sha256 (+ keys)."""
    if output_format not in ("parquet", "csv"):
        raise ValueError("output_format must be 'parquet' or 'csv'")
    return sources.withColumn(
        "fingerprint",
        F.struct(
            F.col("source_name"), F.col("source_size").cast("long").alias("source_size"),
            F.col("source_mtime_ns").cast("long").alias("source_mtime_ns"), F.col("layout_sha256"),
            columns_token(columns).alias("columns"),
            # CSV is raw text, so the flag cannot change its content.
            (F.lit(None).cast("boolean") if output_format == "csv" else F.lit(bool(all_string))).alias("all_string"),
            F.lit(output_format).alias("output_format"),
            F.lit(CONVERSION_FORMAT_VERSION).alias("conversion_format_version"),
        ),
    )


def fingerprint_digest(fp: Column) -> Column:
    """A stable hex digest of a fingerprint struct (nulls as '')."""
    parts = [F.coalesce(fp[f].cast("string"), F.lit("")) for f in FINGERPRINT_FIELDS]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def fingerprints_match(expected: Column, recorded: Column) -> Column:
    cond = recorded.isNotNull()
    for f in FINGERPRINT_FIELDS:
        cond = cond & expected[f].eqNullSafe(recorded[f])
    return cond


def conversion_plan(expected: DataFrame, recorded: DataFrame, key: str = "output", force: bool = False,
                    present: DataFrame | None = None) -> DataFrame:
    """Status per planned output: ``unresolved``, ``skipped`` or ``convert``.

    ``expected`` carries ``layout`` (null when no dictionary matched),
    ``layout_sha256`` (null when the dictionary cannot be read), ``n_text`` (text members) and ``member``; ``recorded`` is the provenance
    table (``output``, ``fingerprint`` — null for legacy records).  ``present``
    lists the outputs that are there now: a record whose output is gone does
    not make it current.
    """
    rec = recorded.select(F.col(key), F.col("fingerprint").alias("recorded_fingerprint"), F.lit(True).alias("_has_record"))
    joined = expected.join(rec, key, "left")
    if present is None:
        joined = joined.withColumn("_there", F.lit(True))
    else:
        joined = joined.join(present.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    known = F.coalesce(F.col("_has_record"), F.lit(False))
    current = known & fingerprints_match(F.col("fingerprint"), F.col("recorded_fingerprint"))
    reason = (
        F.when(F.col("layout").isNull(), F.lit("no layout"))
        .when(F.col("layout_sha256").isNull(), F.lit("unreadable dictionary"))
        .when(F.col("member").isNull() & (F.col("n_text") > 1), F.lit("several text members"))
        .when(F.lit(force), F.lit("forced"))
        .when(F.col("_there").isNull(), F.lit("output absent"))
        .when(~known, F.lit("no record"))
        .when(F.col("recorded_fingerprint").isNull(), F.lit("legacy record"))
        .when(~current, F.lit("inputs changed"))
        .otherwise(F.lit("current"))
    )
    status = (
        F.when(reason.isin("no layout", "unreadable dictionary", "several text members"), F.lit("unresolved"))
        .when(reason == "current", F.lit("skipped"))
        .otherwise(F.lit("convert"))
    )
    return joined.withColumn("reason", reason).withColumn("status", status).drop("_has_record", "_there")


def conversion_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def provenance_rows(converted: DataFrame, source_col: str = "source", n_columns: int | None = None,
                    variables: Iterable[str] | None = None) -> DataFrame:
    """One provenance record per output: row count, column count, variables
    (only when a subset was requested)."""
    var_text = F.lit(",".join(variables)) if variables is not None else F.lit(None).cast("string")
    return converted.groupBy(source_col).agg(F.count(F.lit(1)).alias("rows")).select(
        source_col, "rows",
        F.lit(n_columns if n_columns is not None else len(converted.columns) - 1).alias("columns"),
        var_text.alias("variables"),
    )
