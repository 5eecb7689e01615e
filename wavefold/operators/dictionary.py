"""Dictionary workbooks as tables: grid cells → layout variables.

Input is a cells table ``(doc_id, row_no, c0 … c7)`` of strings (one row per
worksheet row, any number of documents).  Parsing is a handful of window and
grouping steps per document, ordered by ``row_no``:

1. clean every cell (quotes to spaces, whitespace collapsed, numbers read
   with a decimal comma) into twin text/number columns;
2. classify rows: *section*, *variable*, *continuation* or ignored;
3. carry the last section forward and number variables with a running count,
   so continuation rows know which variable they extend;
4. build each variable's category map from its first row and its
   continuations, later codes winning.

A document is one worksheet, which the file format bounds (1,048,576 rows in
``.xlsx``), so per-document windows never see an unbounded partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import CATEGORY_HINTS
from ..functions.text import DECIMAL_PATTERN
from .layout import storage_type_col

CELLS = [f"c{i}" for i in range(8)]


def clean_text(cell: Column) -> Column:
    """Quotes become spaces, whitespace runs collapse, ends are stripped
    (empty cells, the common case, skip the regular expression)."""
    text = F.coalesce(cell, F.lit(""))
    return F.when(text == "", text).otherwise(
        F.trim(F.regexp_replace(F.translate(text, '"', " "), r"(?U)\s+", " ")))


def clean_number(text: Column) -> Column:
    dotted = F.translate(text, ",", ".")
    return F.when((text != "") & dotted.rlike(DECIMAL_PATTERN), dotted.try_cast("double"))


def display(text: Column, num: Column) -> Column:
    """The cell as the parser prints it: integers without a decimal part."""
    return (
        F.when(num.isNotNull() & (num == F.floor(num)), F.floor(num).cast("long").cast("string"))
        .when(num.isNotNull(), num.cast("string"))
        .otherwise(text)
    )


def clean_cells(cells: DataFrame) -> DataFrame:
    out = [F.col("doc_id"), F.col("row_no")]
    for c in CELLS:
        text = clean_text(F.col(c)) if c in cells.columns else F.lit("")
        num = clean_number(text)
        out += [text.alias(f"{c}_t"), num.alias(f"{c}_n"), display(text, num).alias(f"{c}_v")]
    return cells.select(*out)


def _truthy(c: str) -> Column:
    num, text = F.col(f"{c}_n"), F.col(f"{c}_t")
    return F.when(num.isNotNull(), num != 0).otherwise(text != "")


def _is_int(c: str) -> Column:
    num = F.col(f"{c}_n")
    return num.isNotNull() & (num == F.floor(num))


def classify(clean: DataFrame) -> DataFrame:
    section = _truthy("c0") & ~_truthy("c1") & F.col("c0_n").isNull()
    variable = _is_int("c0") & _is_int("c1") & _truthy("c2")
    continuation = ~_truthy("c0") & ~_truthy("c1") & (_truthy("c5") | _truthy("c6"))
    kind = F.when(section, "section").when(variable, "variable").when(continuation, "continuation")
    doc = Window.partitionBy("doc_id").orderBy("row_no")
    running = doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        clean.withColumn("kind", kind)
        .withColumn("var_no", F.sum(F.when(F.col("kind") == "variable", 1).otherwise(0)).over(running))
        .withColumn(
            "section",
            F.coalesce(
                F.last(F.when(F.col("kind") == "section", F.lower("c0_v")), ignorenulls=True).over(running),
                F.lit(""),
            ),
        )
    )


def _categorical_first_row() -> Column:
    hint = F.lower("c5_v")
    by_hint = F.lit(False)
    for token in CATEGORY_HINTS:
        by_hint = by_hint | hint.contains(token)
    return F.col("c5_n").isNotNull() | by_hint


def parse_grid(cells: DataFrame) -> DataFrame:
    """Variables of every document, with categories as a map or a note.

    One shuffle: the per-document window and both aggregations below are
    all clustered by ``doc_id``, so Spark plans a single exchange.
    """
    rows = classify(clean_cells(cells))
    running = Window.partitionBy("doc_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_var = F.col("kind") == "variable"
    has_cats = _truthy("c5") | _truthy("c6")
    categorical = has_cats & _categorical_first_row()
    note_items = F.array(F.when(_truthy("c5"), F.lower("c5_v")), F.when(_truthy("c6"), F.lower("c6_v")))
    note = F.when(is_var & has_cats & ~categorical, F.concat_ws(", ", note_items))
    attrs = F.struct(
        F.lower("c2_v").alias("name"),
        F.col("c0_n").cast("int").alias("start"),
        F.col("c1_n").cast("int").alias("width"),
        (F.col("c0_n") + F.col("c1_n") - 1).cast("int").alias("end"),
        F.col("c3_v").alias("question"),
        F.when(F.lower("c4_v") != "", F.lower("c4_v")).otherwise(F.lower("c2_v")).alias("label"),
        F.col("section"),
        F.lower("c7_v").alias("period"),
        note.alias("category_note"),
        F.col("row_no").alias("row_no"),
    )
    # Continuations extend only a current variable whose categories are a map.
    rows = rows.withColumn("_map_var", F.last(F.when(is_var, note.isNull()), ignorenulls=True).over(running))
    is_entry = (F.col("kind") == "continuation") & (F.col("var_no") > 0) & F.coalesce(F.col("_map_var"), F.lit(False))
    items = rows.filter(is_var | is_entry).select(
        "doc_id", "var_no", "row_no",
        F.when(is_var & categorical, F.col("c5_v"))
        .when(is_entry, F.when(F.col("c5_t") != "", F.col("c5_v")).otherwise(F.lit("vazio"))).alias("key"),
        F.lower("c6_v").alias("value"),
        F.when(is_var, attrs).alias("attrs"),
    )
    # Later rows win for a repeated code: one value per (variable, code).
    per_key = items.groupBy("doc_id", "var_no", "key").agg(
        F.max_by("value", "row_no").alias("value"), F.max("attrs").alias("attrs"))
    per_var = per_key.groupBy("doc_id", "var_no").agg(
        F.max("attrs").alias("a"),
        F.map_from_entries(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value"))))
        .alias("categories"),
    )
    return per_var.select(
        "doc_id", "var_no", F.col("a.row_no").alias("row_no"), "a.name", "a.start", "a.width", "a.end",
        "a.question", "a.label", "a.section", "a.period", "a.category_note",
        F.when(F.col("a.category_note").isNull(),
               F.coalesce(F.col("categories"), F.create_map().cast("map<string,string>"))).alias("categories"),
        storage_type_col(F.col("a.width")).alias("storage_type"),
    )


def categories_text(categories: Column) -> Column:
    """``code=label`` pairs sorted by code, for display and comparison."""
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(categories)), lambda e: F.concat(e["key"], F.lit("="), e["value"])),
        ";",
    )


def layout_problems(variables: DataFrame, documents: DataFrame) -> DataFrame:
    """Duplicate names per document and documents without any variable."""
    dups = variables.groupBy("doc_id", "name").agg(F.count(F.lit(1)).alias("occurrences")).filter(
        F.col("occurrences") > 1).withColumn("problem", F.lit("duplicate name"))
    empty = documents.select("doc_id").distinct().join(variables.select("doc_id").distinct(), "doc_id", "left_anti") \
        .select("doc_id", F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("occurrences"),
                F.lit("no variables").alias("problem"))
    return dups.unionByName(empty)


def document_digest(cells: DataFrame) -> DataFrame:
    """A content hash per document over its cells in row order (the layout
    currency key).  One bounded group per document."""
    line = F.concat_ws("\u001f", *[F.coalesce(F.col(c), F.lit("")) for c in CELLS])
    ordered = F.array_sort(F.collect_list(F.struct(F.col("row_no"), line.alias("line"))))
    return cells.groupBy("doc_id").agg(
        F.sha2(F.array_join(F.transform(ordered, lambda e: e["line"]), "\n"), 256).alias("dictionary_sha256"))


def layout_plan(digests: DataFrame, recorded: DataFrame, force: bool = False) -> DataFrame:
    """Reparse a layout when its recorded dictionary hash differs or is absent."""
    rec = recorded.select("doc_id", F.col("dictionary_sha256").alias("recorded_sha256"))
    joined = digests.join(rec, "doc_id", "left")
    current = F.coalesce(F.col("recorded_sha256") == F.col("dictionary_sha256"), F.lit(False))
    return joined.withColumn("action", F.when(F.lit(force) | ~current, "parse").otherwise("keep"))
