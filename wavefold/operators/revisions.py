"""Catalog records from a listing, newest revision per output, batch filters."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P


def data_records(listing: DataFrame, exclude: Iterable[str] = P.DEFAULT_EXCLUDE, path_col: str = "path") -> DataFrame:
    """Microdata records: ZIPs outside excluded trees that are not documentation
    and hold at least one text member.  Adds scope, kind, period and the member
    to convert (null when there are several)."""
    path = F.col(path_col)
    text_members = F.filter("members", P.is_text_member)
    records = listing.filter(P.zip_suffix(path) & ~P.excluded(path, list(exclude)) & P.is_data_file(path))
    records = records.withColumn("text_members", text_members).filter(F.size("text_members") > 0)
    return records.select(
        "*",
        P.scope(path).alias("scope"),
        P.anual_kind(path).alias("anual_kind"),
        P.period_year(path).alias("year"),
        P.period_quarter(path).alias("quarter"),
        F.when(F.size("text_members") == 1, F.col("text_members")[0]).alias("member"),
        P.file_name(path).alias("name"),
        P.revision_key(P.file_name(path)).alias("revision"),
    )


def output_key(records: DataFrame, output_format: str, flat: bool, path_col: str = "path") -> Column:
    """What a record would be written as; records sharing it are revisions."""
    path = F.col(path_col)
    if flat:
        return F.concat(P.flat_name(F.col("name"), F.col("scope")), F.lit("." + output_format))
    return F.concat(
        F.col("scope"), F.lit("/"), P.parent_dir(path), F.lit("/"),
        P.output_stem(P.stem(F.col("name"))), F.lit("." + output_format),
    )


def latest_revision(
    records: DataFrame, output_format: str = "parquet", flat: bool = False,
    path_col: str = "path", tiebreak: str = "path_id",
) -> DataFrame:
    """Keep one record per output: the later revision date, then the longer
    (greater) name, then the first path in listing order.

    The group is the set of revisions of one output file, which is bounded by
    how often one file is republished, so a per-key window is the right tool.
    """
    keyed = records.withColumn("output_key", output_key(records, output_format, flat, path_col))
    order = [F.col("revision").desc(), F.col("name").desc(), F.col(path_col).asc()]
    if tiebreak in records.columns:
        order.append(F.col(tiebreak).asc())
    w = Window.partitionBy("output_key").orderBy(*order)
    return keyed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def batch_filter(
    records: DataFrame, scope: str | None = None, years: Iterable[int] | None = None,
    quarters: Iterable[int] | None = None,
) -> DataFrame:
    """Scope/year/quarter selection applied *after* the revision choice;
    quarters only restrict the quarterly survey."""
    cond = F.lit(True)
    if scope:
        cond = cond & (F.col("scope") == scope)
    if years:
        cond = cond & F.coalesce(F.col("year").isin(list(years)), F.lit(False))
    if quarters:
        cond = cond & (
            (F.col("scope") != "trimestral") | F.coalesce(F.col("quarter").isin(list(quarters)), F.lit(False))
        )
    return records.filter(cond)
