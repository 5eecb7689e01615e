"""Mirror planning as joins: remote listing ⟗ manifest ⟕ local files.

Produces the reference's dry-run decision for every key without touching the
network: ``unchanged``, ``adopt`` (a file already on disk at the remote size),
``download``, ``stale`` (recorded but gone remotely, within the selected
surveys) and ``kept`` (recorded, outside the selection).  All inputs are
tables keyed by ``survey/path``; the plan is two equi-joins and a projection.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMOTE_FIELDS = ("survey", "path", "url", "size", "etag", "last_modified")
MANIFEST_FIELDS = ("url", "size", "etag", "last_modified", "local", "sha256", "adopted")


def _prefixed(df: DataFrame, prefix: str, fields: Sequence[str]) -> DataFrame:
    """``df`` with prefixed fields; one that the listing does not give is unknown (null)."""
    unknown = {"size": "bigint", "adopted": "boolean", "readable": "boolean"}
    cols = [(F.col(f) if f in df.columns else F.lit(None).cast(unknown.get(f, "string"))).alias(f"{prefix}{f}") for f in fields]
    return df.select(F.col("key"), *cols, F.lit(True).alias(f"{prefix}present"))


def _selected(key, surveys: Sequence[str]):
    cond = F.lit(False)
    for survey in surveys:
        cond = cond | key.startswith(f"{survey}/")
    return cond


def sync_plan(
    remote: DataFrame, manifest: DataFrame, local: DataFrame,
    surveys: Sequence[str] = ("trimestral", "anual"),
) -> DataFrame:
    """One row per key seen anywhere, with its ``status``.

    ``remote``: key, survey, path, url, size, etag, last_modified.
    ``manifest``: key, url, size, etag, last_modified, local, sha256, adopted.
    ``local``: key, size, readable (files present under the mirror root).
    """
    r = _prefixed(remote, "r_", REMOTE_FIELDS)
    m = _prefixed(manifest, "m_", MANIFEST_FIELDS)
    lo = _prefixed(local, "l_", ("size", "readable"))
    joined = r.join(m, "key", "full_outer").join(lo, "key", "left")
    r_on, m_on, l_on = (F.coalesce(F.col(c), F.lit(False)) for c in ("r_present", "m_present", "l_present"))

    def agrees(field: str):
        current = F.col(f"r_{field}")
        return current.isNull() | F.coalesce(F.col(f"m_{field}") == current, F.lit(False))

    size_ok = F.col("r_size").isNull() | F.coalesce(F.col("l_size") == F.col("r_size"), F.lit(False))
    unchanged = (
        r_on & l_on & m_on & size_ok
        & F.coalesce(F.col("m_url") == F.col("r_url"), F.lit(False))
        & agrees("etag") & agrees("last_modified") & agrees("size")
    )
    adopt = (
        r_on & ~m_on & F.col("r_size").isNotNull() & l_on
        & F.coalesce(F.col("l_size") == F.col("r_size"), F.lit(False))
        & F.coalesce(F.col("l_readable"), F.lit(False))
    )
    status = (
        F.when(~r_on & _selected(F.col("key"), surveys), F.lit("stale"))
        .when(~r_on, F.lit("kept"))
        .when(unchanged, F.lit("unchanged"))
        .when(adopt, F.lit("adopt"))
        .otherwise(F.lit("download"))
    )
    return joined.withColumn("status", status)


def stale_keys(remote: DataFrame, manifest: DataFrame, surveys: Sequence[str] = ("trimestral", "anual"),
               period_filtered: bool = False) -> DataFrame:
    """Recorded keys of the selected surveys that are no longer listed remotely.

    Pruning is refused with a period filter, because the remote view is partial.
    """
    if period_filtered:
        raise ValueError("Pruning cannot be combined with period filters because the remote view is partial")
    return manifest.filter(_selected(F.col("key"), surveys)).join(remote.select("key"), "key", "left_anti")


def sync_summary(plan: DataFrame) -> DataFrame:
    """Counters per status, with planned bytes (remote size) per status."""
    return plan.groupBy("status").agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("r_size"), F.lit(0)).cast("long").alias("bytes"),
    )


def manifest_updates(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """Manifest rows of the adopted and the successfully downloaded files of a plan, with their ``origin``.

    ``fetched``: key, sha256, ok — the outcome of the transfers.  A failure gives no row.
    """
    entry = [F.col("key"), F.col("r_survey").alias("survey"), F.col("r_path").alias("path"),
             F.col("r_url").alias("url"), F.col("r_size").alias("size"), F.col("r_etag").alias("etag"),
             F.col("r_last_modified").alias("last_modified"),
             F.concat(F.lit("originals/"), F.col("key")).alias("local")]
    adopted = plan.filter(F.col("status") == "adopt").select(
        *entry, F.lit(None).cast("string").alias("sha256"), F.lit(True).alias("adopted"),
        F.lit("adopted").alias("origin"))
    downloaded = (
        plan.filter(F.col("status") == "download")
        .join(fetched.filter(F.col("ok")).select("key", "sha256"), "key")
        .select(*entry, F.col("sha256"), F.lit(None).cast("boolean").alias("adopted"), F.lit("downloaded").alias("origin"))
    )
    return adopted.unionByName(downloaded)


def manifest_merge(manifest: DataFrame, plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """New manifest: kept rows plus ``manifest_updates``.

    Failures keep their previous row (if any), so successes are never lost.
    """
    updates = manifest_updates(plan, fetched)
    kept = manifest.join(updates.select("key"), "key", "left_anti").select(
        "key", "survey", "path", "url", "size", "etag", "last_modified", "local", "sha256",
        F.col("adopted").cast("boolean").alias("adopted"), F.lit("kept").alias("origin"))
    return kept.unionByName(updates)
