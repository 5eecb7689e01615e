"""Mirror verification: manifest ⟕ files, digest comparison, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escapes_root(local: Column) -> Column:
    """True for an absolute path or one whose ``..`` segments climb above the root."""
    parts = F.split(local, "/")
    state = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("depth"), F.lit(False).alias("out")),
        lambda acc, seg: F.when(
            seg == "..",
            F.struct((acc["depth"] - 1).alias("depth"), (acc["out"] | (acc["depth"] - 1 < 0)).alias("out")),
        ).when(
            seg.isin("", "."), acc
        ).otherwise(F.struct((acc["depth"] + 1).alias("depth"), acc["out"].alias("out"))),
    )
    return local.startswith("/") | state["out"]


def verify_files(manifest: DataFrame, files: DataFrame, deep: DataFrame | None = None) -> DataFrame:
    """Status per manifest entry.

    ``manifest``: key, local, size, sha256 (null for adopted files).
    ``files``: local, file_size, digest (sha256 of the content, computed with
    ``sha2`` on a ``binaryFile``/text column by the caller).
    ``deep``: optional local, crc_ok, bad_member — the CRC result for archives
    without a recorded hash.
    Checks in order: path escape, missing, size, digest; no hash → unverifiable
    (or the CRC verdict when ``deep`` is given).
    """
    f = files.select("local", "file_size", "digest", F.lit(True).alias("_present"))
    joined = manifest.join(f, "local", "left")
    if deep is not None:
        joined = joined.join(deep.select("local", "crc_ok", "bad_member"), "local", "left")
    present = F.coalesce(F.col("_present"), F.lit(False))
    size_bad = F.col("size").isNotNull() & (F.col("file_size") != F.col("size"))
    has_hash = F.coalesce(F.length("sha256") > 0, F.lit(False))
    status = (
        F.when(escapes_root(F.col("local")), F.lit("failed"))
        .when(~present, F.lit("failed"))
        .when(size_bad, F.lit("failed"))
        .when(has_hash & (F.col("digest") != F.col("sha256")), F.lit("failed"))
        .when(has_hash, F.lit("ok"))
    )
    detail = (
        F.when(escapes_root(F.col("local")), F.lit("manifest path escapes the repository"))
        .when(~present, F.lit("missing"))
        .when(size_bad, F.format_string("size %d != recorded %d", F.col("file_size"), F.col("size")))
        .when(has_hash & (F.col("digest") != F.col("sha256")), F.lit("sha256 mismatch"))
        .when(has_hash, F.lit(""))
    )
    if deep is not None and "crc_ok" in joined.columns:
        is_zip = F.lower(F.col("local")).endswith(".zip")
        status = status.when(is_zip & F.col("crc_ok"), F.lit("ok")).when(is_zip, F.lit("failed"))
        detail = detail.when(is_zip & F.col("crc_ok"), F.lit("")).when(
            is_zip, F.concat(F.lit("CRC failure in member "), F.coalesce(F.col("bad_member"), F.lit("?"))))
    status = status.otherwise(F.lit("unverifiable"))
    detail = detail.otherwise(F.lit(""))
    return joined.select("key", status.alias("status"), detail.alias("detail"))


def verify_summary(result: DataFrame) -> DataFrame:
    return result.agg(
        F.count(F.lit(1)).alias("checked"),
        F.sum(F.when(F.col("status") == "ok", 1).otherwise(0)).cast("long").alias("ok"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).cast("long").alias("failed"),
        F.sum(F.when(F.col("status") == "unverifiable", 1).otherwise(0)).cast("long").alias("unverifiable"),
    )
