"""Incremental archive unpacking as table operations.

``unpack_plan`` compares each archive's (size, mtime) with the recorded state;
``obsolete_members`` lists previously extracted files that a changed archive
no longer produces, plus everything recorded for archives that vanished;
``unsafe_members`` flags member names that would escape the target directory.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P


def unpack_plan(archives: DataFrame, state: DataFrame, exclude: Iterable[str] = P.DEFAULT_EXCLUDE,
                force: bool = False) -> DataFrame:
    """``archives``: archive, size, mtime_ns; ``state``: archive, size, mtime_ns, outputs.

    action: ``excluded`` (listed but outside the selection), ``process``
    (new, changed or forced) or ``skip``.
    """
    st = state.select("archive", F.col("size").alias("s_size"), F.col("mtime_ns").alias("s_mtime_ns"),
                      F.col("outputs").alias("previous_outputs"))
    joined = archives.join(st.hint("merge"), "archive", "left")
    same = F.col("s_size").eqNullSafe(F.col("size")) & F.col("s_mtime_ns").eqNullSafe(F.col("mtime_ns")) \
        & F.col("s_size").isNotNull()
    action = (
        F.when(P.excluded(F.col("archive"), list(exclude)), F.lit("excluded"))
        .when(F.lit(force) | ~same, F.lit("process"))
        .otherwise(F.lit("skip"))
    )
    return joined.withColumn("action", action)


def extracted_path(archive: Column, member: Column) -> Column:
    """``extracted/<archive without .zip, relative to originals>/<member>``."""
    base = F.regexp_replace(F.regexp_replace(archive, r"^originals/", ""), r"(?i)\.zip$", "")
    return F.concat(F.lit("extracted/"), base, F.lit("/"), F.translate(member, "\\", "/"))


def obsolete_members(plan: DataFrame, current: DataFrame, state: DataFrame) -> DataFrame:
    """Files to remove: outputs of processed archives not produced now, and all
    outputs of archives no longer listed.

    The sides of both joins are merged in order: member lists unpack to far more than the files they come from, too much to send whole
    to every task.

    ``current``: archive, output (one row per member extracted now).
    """
    processed = plan.filter(F.col("action") == "process").select(
        "archive", F.explode_outer("previous_outputs").alias("output")).filter(F.col("output").isNotNull())
    dropped = processed.join(current.select("archive", "output").hint("merge"), ["archive", "output"], "left_anti") \
        .withColumn("reason", F.lit("dropped member"))
    listed = plan.select("archive")
    vanished = state.join(listed.hint("merge"), "archive", "left_anti").select(
        "archive", F.explode("outputs").alias("output")).withColumn("reason", F.lit("archive removed"))
    return dropped.unionByName(vanished)


def unsafe_reason(member: Column) -> Column:
    """Why a member name is unsafe (absolute, parent traversal), else null."""
    norm = F.translate(member, "\\", "/")
    return (
        F.when(norm.startswith("/") | norm.rlike(r"^[A-Za-z]:/"), F.lit("absolute path"))
        .when(F.array_contains(F.split(norm, "/"), ".."), F.lit("parent traversal"))
    )


def unsafe_members(members: DataFrame) -> DataFrame:
    """``members``: archive, member.  One row per unsafe member; any such row
    fails its whole archive."""
    return members.withColumn("reason", unsafe_reason(F.col("member"))).filter(F.col("reason").isNotNull())
