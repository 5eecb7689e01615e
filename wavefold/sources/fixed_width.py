"""Fixed-width text scan: lines in, typed columns out.

``parse_lines`` turns any DataFrame with a line column into the typed columns
of a layout with generated projections.  Only the requested variables are
sliced (Catalyst prunes the rest anyway), ASCII lines are sliced by byte
offset and only non-ASCII lines pay for code-point slicing, and each row
carries ``_errors``: the names of selected fields whose text did not parse
(comma-separated, '' when clean).
Rows are never dropped; a caller decides per source file what to do with
errors (see ``plans.convert``).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.layout import Layout, Variable

ERRORS = "_errors"
ASCII_FLAG = "_ascii"


def parse_lines(
    lines: DataFrame,
    layout: Layout,
    columns: Iterable[str] | None = None,
    all_string: bool = False,
    value_col: str = "value",
    keep: Iterable[str] = (),
    with_errors: bool = True,
) -> DataFrame:
    """Slice, trim and type the fields of ``value_col`` according to ``layout``.

    ``keep`` lists pass-through columns (for example ``source``/``line_no``).
    ``_errors`` is a comma-separated list of the selected fields whose text
    did not parse ('' when the record is clean); an invalid UTF-8 line
    reports ``<encoding>``.

    The plan is five narrow projections kept apart on purpose: the ASCII
    test, one trimmed text column per field, the missing-value rule, the
    typed values, then the error list.  Each intermediate column is used more than once downstream,
    so Catalyst keeps the projections separate instead of inlining (and
    recomputing) them, and every step stays inside one whole-stage-generated
    stage (no higher-order functions, which would fall back to
    interpretation).
    """
    variables = layout.select(columns)
    keep = list(keep)
    value = F.col(value_col)
    staged = lines.select(*keep, value.alias("_line"), value.cast("binary").alias("_bin"),
                          tx.is_ascii_line(value).alias(ASCII_FLAG))
    raw = staged.select(
        *keep, "_line",
        *[tx.field_text(F.col("_line"), v.start, v.width, F.col(ASCII_FLAG), F.col("_bin")).alias(f"_r{i}")
          for i, v in enumerate(variables)],
    )
    texts = raw.select(*keep, "_line", *[tx.missing_to_null(F.col(f"_r{i}")).alias(f"_t{i}")
                                         for i in range(len(variables))])
    kinds = ["string" if all_string else v.kind for v in variables]
    typed = texts.select(
        *keep, "_line", *[f"_t{i}" for i in range(len(variables))],
        *[tx.typed_value(F.col(f"_t{i}"), kind).alias(v.name) for i, (v, kind) in enumerate(zip(variables, kinds))],
    )
    out = [F.col(c) for c in keep] + [F.col(v.name) for v in variables]
    if with_errors:
        markers = [
            F.when(F.col(f"_t{i}").isNotNull() & F.col(v.name).isNull(), F.lit(v.name))
            for i, (v, kind) in enumerate(zip(variables, kinds)) if kind != "string"
        ]
        bad_utf8 = F.when(~F.is_valid_utf8(F.col("_line")), F.lit("<encoding>"))
        out.append(F.concat_ws(",", bad_utf8, *markers).alias(ERRORS))
    return typed.select(*out)


def raw_fields(lines: DataFrame, layout: Layout, value_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Trimmed field text with missing-value rules applied and no typing (CSV form)."""
    return parse_lines(lines, layout, None, True, value_col, keep, with_errors=False)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines of plain files, with the file they came from."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("value"),
    )


def read_fixed_width(
    spark: SparkSession,
    paths: str | list[str],
    layout: Layout,
    columns: Iterable[str] | None = None,
    all_string: bool = False,
) -> DataFrame:
    """Typed scan of plain fixed-width files (one job for any number of files)."""
    return parse_lines(read_lines(spark, paths), layout, columns, all_string, keep=["source"])
