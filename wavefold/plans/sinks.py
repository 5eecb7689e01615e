"""Writers: Parquet and CSV outputs, layout documents, provenance, file index.

Outputs are always written to a staging location first and published only
when complete (K10); Spark's commit protocol makes each write all-or-nothing
per job, and an existing target is refused unless ``force``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# CSV dialect of Python's csv.writer defaults (header, minimal
# quoting, doubled quotes, CRLF line ends, empty text for missing values).
CSV_OPTIONS = {
    "header": "true",
    "lineSep": "\r\n",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "quoteAll": "false",
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def remove(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``.

    A folder that is already there steps aside first and goes only after the
    new one is in place, so a failure in between loses nothing.
    """
    jvm = spark._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    parent = dst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    replaced = fs.exists(dst)
    if replaced and not fs.rename(dst, aside):
        raise IOError(f"{target} is in use and stays as it is")
    if not fs.rename(src, dst):
        if replaced:
            fs.rename(aside, dst)
        raise IOError(f"{source} is complete but could not take the place of {target}")
    if replaced:
        fs.delete(aside, True)


def publish(spark: SparkSession, df: DataFrame, target: str, fmt: str = "parquet", force: bool = False,
            options: dict | None = None) -> str:
    """Write ``df`` to ``target`` through a sibling staging directory of its own."""
    if fmt not in ("parquet", "csv", "json", "text"):
        raise ValueError("fmt must be parquet, csv, json or text")
    if _exists(spark, target) and not force:
        raise FileExistsError(f"{target} is there already (force=True replaces it)")
    staging = f"{target.rstrip('/')}.part-{uuid.uuid4().hex[:8]}"
    writer = df.write
    defaults = {"compression": "zstd"} if fmt == "parquet" else {}
    for key, value in (defaults | (options or {})).items():
        writer = writer.option(key, value)
    try:
        writer.format(fmt).save(staging)
        _rename(spark, staging, target)
    finally:
        remove(spark, staging)
    return target


def publish_sorted(df: DataFrame, keys: list[str], target: str) -> str:
    """``publish`` as Parquet in the order of ``keys``: part files follow one another by range, rows inside them by key."""
    return publish(df.sparkSession, df.orderBy(*keys), target, "parquet", force=True)


# The fields of a variable in a layout document.
DOCUMENT_FIELDS = ("name", "start", "width", "end", "label", "section", "question", "period", "categories",
                   "category_note", "storage_type")


def write_layout_documents(variables: DataFrame, target: str, id_col: str = "doc_id",
                           digests: DataFrame | None = None) -> str:
    """One layout JSON document per dictionary (schema version 1), variables in dictionary order.

    ``digests`` (``id_col, dictionary_sha256``) records the dictionary that a
    document was made from.  A dictionary is a worksheet, so collecting its
    variables into one document is a bounded group.
    """
    fields = [f for f in DOCUMENT_FIELDS if f in variables.columns]
    ordered = F.array_sort(F.collect_list(F.struct("row_no", *fields)),
                           lambda a, b: F.when(a["row_no"] < b["row_no"], -1).when(a["row_no"] > b["row_no"], 1).otherwise(0))
    docs = variables.groupBy(id_col).agg(ordered.alias("v"))
    source = F.create_map().cast("map<string,string>")
    if digests is not None:
        docs = docs.join(digests.select(id_col, "dictionary_sha256"), id_col, "left")
        source = F.create_map(F.lit("dictionary_sha256"), F.col("dictionary_sha256"))
    docs = docs.select(F.col(id_col).cast("string").alias("layout_id"), F.lit(1).alias("schema_version"), source.alias("source"),
                       F.transform("v", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("variables"))
    return publish(variables.sparkSession, docs, target, "json", force=True)


def flat_index(listing: DataFrame, produced: DataFrame | None = None) -> DataFrame:
    """``{name, size, files}`` per converted Parquet output, sorted by name.

    ``listing``: name, size (sum of the part files of an output directory);
    ``produced``: name, files ARRAY<STRING> (source and layout of each output).
    """
    rows = listing
    if produced is not None:
        rows = rows.join(produced, "name", "left")
    else:
        rows = rows.withColumn("files", F.lit(None).cast("array<string>"))
    return rows.select(
        "name", "size", F.coalesce("files", F.array().cast("array<string>")).alias("files")
    ).orderBy("name")


def write_flat_index(index: DataFrame, target_file: str) -> str:
    """JSON lines in name order; an empty catalog gives an empty file.

    The index has one line per output file (thousands at most), so it is
    written through a single partition and the part file is then renamed to
    ``target_file`` with the Hadoop file system (works on any cluster store).
    """
    spark = index.sparkSession
    lines = index.select(F.to_json(F.struct("name", "size", "files")).alias("value"))
    staging = f"{target_file}.part-{uuid.uuid4().hex[:8]}"
    lines.coalesce(1).write.text(staging)
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(staging)
    fs = folder.getFileSystem(conf)
    parts = [st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().startswith("part-")]
    target = jvm.org.apache.hadoop.fs.Path(target_file)
    if fs.exists(target):
        fs.delete(target, False)
    if parts:
        fs.rename(parts[0], target)
    else:
        fs.create(target).close()
    fs.delete(folder, True)
    return target_file
