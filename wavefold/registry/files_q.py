"""Registered queries over files that Spark first writes from the driver tables.

Fixtures live under the shared checkpoint folder (``spark.checkpoint.dir``)
and are written by Spark jobs, one bounded group per file:

* one ZIP per block of 1,000 ``lineitem`` order keys, holding that block's
  rendered records (line ends ``\\n``, ``\\r\\n`` or ``\\r`` by block), plus a
  stored copy with one flipped payload byte for every fifth block;
* one unreadable ``.zip`` per ``region`` row and one ZIP without a text
  member per ``nation`` row;
* one ``.xlsx`` workbook per dictionary document of the grid;
* converted Parquet and CSV outputs (one directory per source).

Fixtures are written once per application and reused by every key.
"""

from __future__ import annotations

import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import verify as V
from ..operators.layout import Layout, Variable
from ..operators.ordered import rank_within
from ..operators.panel import ORDINAL, read_waves
from ..plans.convert import convert_lines, plan_blocks
from ..plans.sinks import publish_sorted
from ..plans.snapshots import SnapshotTable
from ..sources import archives as A
from ..sources import workbook as WB
from ..sources.fixed_width import ERRORS, parse_lines
from ..session import ship_package, staged, staging_path
from . import dictionary_q as DQ
from . import fixed_width_q as FQ
from . import paths_q as PQ
from .common import table
from .paths_q import archive_paths

_CACHE: dict = {}
BLOCK = 1000


def _key(spark: SparkSession, sf_dir: str, kind: str):
    return (spark.sparkContext.applicationId, sf_dir, kind)


def _in_order(rows: pa.Table) -> tuple[int, list[str]]:
    """Number of a block and its lines in order."""
    rows = rows.sort_by([("line_no", "ascending"), ("tie", "ascending")])
    return int(rows["block"][0].as_py()), rows["value"].to_pylist()


def _packed(written: list[tuple[str, int]]) -> pa.Table:
    return pa.table({"file": [f for f, _ in written], "lines": pa.array([n for _, n in written], pa.int64())})


def _blocked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = FQ.fw_lines(spark, sf_dir)
    return lines.select(F.expr(f"line_no div {8 * BLOCK}").alias("block"), "line_no", "tie", "value")


def _pack_block(root: str):
    def run(rows: pa.Table) -> pa.Table:
        block, values = _in_order(rows)
        sep = ["\n", "\r\n", "\r"][block % 3]
        name = f"lineitem_{block:05d}"
        payload = (sep.join(values) + sep).encode("utf-8")
        A.write_bytes(f"{root}/lineitem/{name}.zip", A.zip_bytes([(f"{name}.txt", payload)]))
        written = [(f"lineitem/{name}.zip", len(values))]
        if block % 5 == 0:
            import io
            import zipfile

            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", compression=zipfile.ZIP_STORED) as z:
                z.writestr(f"{name}.txt", payload)
            data = bytearray(buffer.getvalue())
            offset = 30 + len(f"{name}.txt") + len(payload) // 2  # inside the stored member
            data[offset] ^= 0xFF
            A.write_bytes(f"{root}/tampered/{name}.zip", bytes(data))
            written.append((f"tampered/{name}.zip", len(values)))
        return _packed(written)

    return run


def _pack_mixed(root: str):
    """One ZIP per block for the conversion: clean, bad field, bad byte, damaged, empty, by block."""
    def run(rows: pa.Table) -> pa.Table:
        block, values = _in_order(rows)
        name, kind = f"mixed_{block:05d}", block % 6
        lines = values if kind == 1 else [v[:26] + "0001" + v[30:] for v in values]
        payload = ("\n".join(lines) + "\n").encode("utf-8")
        middle = len(payload) // 2
        if kind == 2:
            payload = payload[:middle] + b"\xff" + payload[middle:]
        data = bytearray(A.zip_bytes([(f"{name}.txt", b"" if kind == 4 else payload)]))
        if kind == 3:
            data[30 + len(f"{name}.txt")] = 0xFF  # an invalid block type at the start of the deflate stream
        A.write_bytes(f"{root}/mixed/{name}.zip", bytes(data))
        return _packed([(f"mixed/{name}.zip", len(values))])

    return run


def _odd_archives(root: str):
    def run(batches):
        for pdf in batches:
            out = []
            for kind, key, text in zip(pdf["kind"], pdf["key"], pdf["text"]):
                if kind == "broken":
                    name = f"broken/broken_{key}.zip"
                    A.write_bytes(f"{root}/{name}", ("not a zip " + text).encode("utf-8") * 3)
                else:
                    name = f"docs/docs_{key}.zip"
                    A.write_bytes(f"{root}/{name}", A.zip_bytes([(f"notas_{key}.pdf", text.encode("utf-8"))]))
                out.append((name,))
            yield pd.DataFrame(out, columns=["file"])

    return run


def archive_root(spark: SparkSession, sf_dir: str) -> str:
    ship_package(spark)
    key = _key(spark, sf_dir, "archives")
    if key in _CACHE:
        return _CACHE[key]
    root = staging_path(spark, "archives")
    packed = _blocked_lines(spark, sf_dir).groupBy("block").applyInArrow(_pack_block(root), "file string, lines long")
    packed.write.format("noop").mode("overwrite").save()
    region = FQ.table(spark, sf_dir, "region").select(F.lit("broken").alias("kind"), F.col("r_regionkey").cast("string").alias("key"), F.col("r_name").alias("text"))
    nation = FQ.table(spark, sf_dir, "nation").select(F.lit("docs").alias("kind"), F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("text"))
    region.unionByName(nation).mapInPandas(_odd_archives(root), "file string").collect()
    _CACHE[key] = root
    return root


def mixed_root(spark: SparkSession, sf_dir: str) -> str:
    ship_package(spark)
    key = _key(spark, sf_dir, "mixed")
    if key not in _CACHE:
        root = staging_path(spark, "archives")
        packed = _blocked_lines(spark, sf_dir).groupBy("block").applyInArrow(_pack_mixed(root), "file string, lines long")
        packed.write.format("noop").mode("overwrite").save()
        _CACHE[key] = root
    return _CACHE[key]


def _rel(root: str, col: str = "path") -> F.Column:
    return F.regexp_extract(F.col(col), r"wavefold-stage/archives-[0-9a-f]+/(.*)$", 1)


def _zips(spark, sf_dir, sub: str) -> DataFrame:
    root = archive_root(spark, sf_dir)
    return A.file_listing(spark, f"{root}/{sub}", zips_only=True)


def q_archive_line_scan(spark, sf_dir):
    lines = A.archive_lines(_zips(spark, sf_dir, "lineitem")).filter(F.col("error").isNull())
    parsed = parse_lines(lines, FQ.LINE_LAYOUT, keep=["member", "line_no"])
    return parsed.withColumn("parse_errors", F.col(ERRORS)).drop(ERRORS)


def q_archive_inventory(spark, sf_dir):
    root = archive_root(spark, sf_dir)
    inv = A.archive_inventory(A.file_listing(spark, root, zips_only=True))
    kept = inv.filter(F.col("readable") & (F.size("text_members") > 0))
    return kept.select(_rel(root, "archive").alias("archive"), F.array_join("text_members", "|").alias("text_members"))


def q_file_listing(spark, sf_dir):
    root = archive_root(spark, sf_dir)
    listing = A.file_listing(spark, root)
    return listing.select(_rel(root).alias("file"), F.lower(F.col("path")).endswith(".zip").alias("is_zip"))


def q_unpack_rows(spark, sf_dir):
    key = _key(spark, sf_dir, "unpack")
    zips = _zips(spark, sf_dir, "lineitem").withColumn("relative", F.regexp_extract("path", r"/(lineitem/[^/]+)$", 1))
    target = _CACHE.get(key) or staging_path(spark, "extracted")
    _CACHE[key] = target
    out = A.unpack_archives(zips, target)
    return out.select(
        F.regexp_extract("archive", r"/(lineitem/[^/]+)$", 1).alias("archive"), "member",
        F.regexp_extract("output", r"/(lineitem/[^/]+/[^/]+)$", 1).alias("output"), "error")


def q_verify_deep(spark, sf_dir):
    root = archive_root(spark, sf_dir)
    zips = A.file_listing(spark, root, zips_only=True).filter(~F.col("path").contains("/broken/") & ~F.col("path").contains("/docs/"))
    manifest = zips.select(_rel(root).alias("key"), F.col("path").alias("local"),
                           F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("sha256"))
    files = zips.select(F.col("path").alias("local"), F.col("size").alias("file_size"),
                        F.lit(None).cast("string").alias("digest"))
    deep = A.crc_check(zips).withColumnRenamed("archive", "local")
    return V.verify_files(manifest, files, deep).select("key", "status")


# --------------------------------------------------------------- workbooks


def _write_workbook(root: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_no")
        doc = int(pdf["doc_id"].iloc[0])
        rows = pdf[[f"c{i}" for i in range(8)]].fillna("").values.tolist()
        A.write_bytes(f"{root}/dict_{doc}.xlsx", WB.xlsx_bytes(rows))
        return pd.DataFrame([(doc, len(rows))], columns=["doc_id", "rows"])

    return run


def workbook_root(spark: SparkSession, sf_dir: str) -> str:
    ship_package(spark)
    key = _key(spark, sf_dir, "workbooks")
    if key in _CACHE:
        return _CACHE[key]
    root = staging_path(spark, "workbooks")
    DQ.grid_cells(spark, sf_dir).groupBy("doc_id").applyInPandas(_write_workbook(root), "doc_id long, rows long").collect()
    _CACHE[key] = root
    return root


def q_dictionary_cells(spark, sf_dir):
    root = workbook_root(spark, sf_dir)
    books = A.file_listing(spark, root).filter(F.col("path").endswith(".xlsx"))
    cells = WB.workbook_cells(books)
    return cells.select(WB.doc_name().alias("doc"), "row_no", *[f"c{i}" for i in range(8)])


# -------------------------------------------------------------- conversion


def _converted(spark, sf_dir, fmt: str, columns=None, label="converted"):
    key = _key(spark, sf_dir, f"{label}-{fmt}")
    if key not in _CACHE:
        target = staging_path(spark, f"{label}-{fmt}")
        report = convert_lines(spark, FQ.fw_lines(spark, sf_dir, faults=False), FQ.LINE_LAYOUT, target, fmt, columns)
        _CACHE[key] = (target, report.collect())
    return _CACHE[key]


def q_conversion_run(spark, sf_dir):
    """Archives of every kind in one conversion: each is published whole or rejected with its reason."""
    key = _key(spark, sf_dir, "mixed-report")
    if key not in _CACHE:
        root = mixed_root(spark, sf_dir)
        zips = A.file_listing(spark, f"{root}/mixed", zips_only=True).repartition(
            int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
        lines = A.archive_lines(zips).withColumnRenamed("archive", "source")
        _CACHE[key] = convert_lines(spark, lines, FQ.LINE_LAYOUT, staging_path(spark, "mixed-out"),
                                    sources=A.member_bytes(zips).withColumnRenamed("path", "source"))
    fault = F.col("first_error")
    why = (F.when(fault.startswith("damaged archive"), "damaged").when(fault.contains("while reading as"), "decoding")
           .otherwise(fault))
    converted = F.col("status") == "converted"
    return _CACHE[key].select(
        F.regexp_extract("source", r"/(mixed/[^/]+)$", 1).alias("source"), "status", why.alias("reason"),
        F.when(converted, F.col("rows")).alias("rows"), F.regexp_extract("output", r"/([^/]+)$", 1).alias("output"))


def q_conversion_rows(spark, sf_dir):
    """The published rows of the mixed conversion, all columns, read back."""
    q_conversion_run(spark, sf_dir)
    report = _CACHE[_key(spark, sf_dir, "mixed-report")]
    outputs = [r["output"] for r in report.filter("status = 'converted'").select("output").collect()]
    return spark.read.parquet(*outputs)


def _published(spark, sf_dir, fmt):
    target, report = _converted(spark, sf_dir, fmt)
    return [r["output"] for r in report if r["status"] == "converted"]


def q_parquet_roundtrip(spark, sf_dir):
    return spark.read.parquet(*_published(spark, sf_dir, "parquet"))


def q_csv_roundtrip(spark, sf_dir):
    return spark.read.option("header", "true").option("lineSep", "\r\n").csv(_published(spark, sf_dir, "csv"))


def q_csv_one_column(spark, sf_dir):
    """One column with missing values: every record has a line (read as lines, whatever a CSV reader makes of them)."""
    target, report = _converted(spark, sf_dir, "csv", ["partkey"], "one-column")
    lines = spark.read.option("lineSep", "\r\n").text([r["output"] for r in report if r["status"] == "converted"])
    return lines.filter("value <> 'partkey'").select("value")


TASK_SIZES = (1 << 15, 1 << 18)
# Scan tasks of small files (some 30 of them each) that are read by one.
READ_TOGETHER = 8


def _numbered_layout() -> Layout:
    """The record behind a line number of 18 digits."""
    moved = [Variable(v.name, v.start + 18, v.width) for v in FQ.LINE_LAYOUT.variables]
    return Layout([Variable("line_no", 1, 18), *moved])


def q_conversion_order(spark, sf_dir):
    """Lines of sources that are many part files, read back by file and row: the place of each is that of its line.

    The smaller task size cuts every source into some tens of files.
    """
    key = _key(spark, sf_dir, "ordered")
    if key not in _CACHE:
        lines = FQ.fw_lines(spark, sf_dir, faults=False)
        lines = lines.withColumn("value", F.concat(F.lpad(F.col("line_no").cast("string"), 18, "0" * 18), "value")).repartition("tie")
        # Rendered once; the conversion reads its lines twice, and those that share a number in the order they have here.
        lines = staged(lines.drop("tie").withColumn("place", F.monotonically_increasing_id()), "ordered-lines")
        target = staging_path(spark, "ordered-out")
        convert_lines(spark, lines, _numbered_layout(), target, columns=["line_no"], task_bytes=TASK_SIZES[0])
        _CACHE[key] = target
    (wave,) = read_waves(spark, [f"{_CACHE[key]}/*.parquet"])
    read = wave.withColumn("source", F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1))
    # Opening many small files takes most of the time: they are read once, by fewer tasks, not again to find the ranges of the rank.
    tasks = max(4 * spark.sparkContext.defaultParallelism, read.rdd.getNumPartitions() // READ_TOGETHER)
    read = staged(read.coalesce(tasks), "ordered-read")
    return rank_within(read, ["source"], ORDINAL, "place").select("source", "line_no", F.col("place").cast("long").alias("place"))


def q_conversion_tasks(spark, sf_dir):
    """The plan of a conversion for two task sizes: blocks and first task of each source from the bytes of all of them."""
    lines = FQ.fw_lines(spark, sf_dir)
    sizes = lines.groupBy("source").agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    plans = [plan_blocks(sizes, size).select(F.lit(size).cast("long").alias("task_bytes"), "source", "bytes", "blocks", "first_task")
             for size in TASK_SIZES]
    return plans[0].unionByName(plans[1])


def q_sorted_listing(spark, sf_dir):
    """The archive listing published in path order, read back by file and row: every path's place on disk."""
    target = staging_path(spark, "sorted-listing")
    publish_sorted(archive_paths(spark, sf_dir).select("path", "path_id", "size"), ["path", "path_id"], target)
    (read,) = read_waves(spark, [target])
    return rank_within(read.withColumn("_all", F.lit(0)), ["_all"], ORDINAL, "place").select(
        "path", "path_id", "size", F.col("place").cast("long").alias("place"))


def q_snapshot_state(spark, sf_dir):
    """Orders of a customer by year, committed year after year to a table keyed by customer that is compacted every third commit."""
    table_ = SnapshotTable(spark, staging_path(spark, "snapshots"), "custkey long, year int, orders long, last_key long", ["custkey"], 3)
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    span = orders.agg(F.min("year").alias("low"), F.max("year").alias("high")).first()
    for year in range(span["low"], span["high"] + 1) if span["low"] is not None else ():
        table_.commit(orders.filter(F.col("year") == year).groupBy(F.col("o_custkey").alias("custkey"), "year").agg(
            F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("last_key")))
    return table_.read()


def q_dataset_projection(spark, sf_dir):
    return spark.read.parquet(*_published(spark, sf_dir, "parquet")).select("orderkey", "suppkey")


def q_dataset_filter(spark, sf_dir):
    return spark.read.parquet(*_published(spark, sf_dir, "parquet")).select(
        "orderkey", "extendedprice").filter(F.col("extendedprice") >= 50000)


def q_flat_index(spark, sf_dir):
    from ..plans.sinks import flat_index

    target, report = _converted(spark, sf_dir, "parquet")
    files = A.file_listing(spark, target).filter(F.col("path").endswith(".parquet")).select(
        F.regexp_extract("path", r"/([^/]+\.parquet)/[^/]+$", 1).alias("name"), "size")
    sizes = files.filter(F.col("name") != "").groupBy("name").agg(F.sum("size").alias("size"))
    produced = spark.createDataFrame(
        [(r["output"].rsplit("/", 1)[-1], [r["source"], "layout:lineitem"]) for r in report if r["status"] == "converted"],
        "name string, files array<string>")
    index = flat_index(sizes, produced)
    return index.select("name", F.array_join("files", "|").alias("files"), (F.col("size") > 0).alias("has_bytes"))


QUERIES = {
    "archive_line_scan": q_archive_line_scan,
    "archive_inventory": q_archive_inventory,
    "file_listing": q_file_listing,
    "unpack_rows": q_unpack_rows,
    "verify_deep": q_verify_deep,
    "dictionary_cells": q_dictionary_cells,
    "conversion_run": q_conversion_run,
    "conversion_rows": q_conversion_rows,
    "csv_one_column": q_csv_one_column,
    "conversion_order": q_conversion_order,
    "conversion_tasks": q_conversion_tasks,
    "sorted_listing": q_sorted_listing,
    "snapshot_state": q_snapshot_state,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "dataset_projection": q_dataset_projection,
    "dataset_filter": q_dataset_filter,
    "flat_index": q_flat_index,
}

# ---------------------------------------------------------------- oracle SQL

_BLOCKED = f"""
  SELECT *, l_orderkey // {BLOCK} AS block,
         printf('lineitem_%05d', l_orderkey // {BLOCK}) AS stem,
         row_number() OVER (PARTITION BY l_orderkey // {BLOCK} ORDER BY l_orderkey * 8 + l_linenumber,
                            printf('%09d%010d%015.2f', l_partkey, l_suppkey, l_extendedprice)) AS pos
  FROM lineitem"""

_EXP = FQ._EXPECTED.replace("FROM lineitem", f"FROM ({_BLOCKED})").replace(
    "SELECT\n  l_orderkey * 8 + l_linenumber AS line_no,",
    "SELECT\n  stem || '.txt' AS member, pos AS line_no,")

_BLOCKS = f"SELECT DISTINCT l_orderkey // {BLOCK} AS block, printf('lineitem_%05d', l_orderkey // {BLOCK}) AS stem FROM lineitem"

_FILES = f"""
  SELECT 'lineitem/' || stem || '.zip' AS file FROM ({_BLOCKS})
  UNION ALL SELECT 'tampered/' || stem || '.zip' FROM ({_BLOCKS}) WHERE block % 5 = 0
  UNION ALL SELECT 'broken/broken_' || CAST(r_regionkey AS VARCHAR) || '.zip' FROM region
  UNION ALL SELECT 'docs/docs_' || CAST(n_nationkey AS VARCHAR) || '.zip' FROM nation"""

_TYPED = FQ.without_faults(FQ._EXPECTED, "CAST(l_quantity AS INTEGER)")
_TEXT = FQ.without_faults(FQ._TEXT, "lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 4, '0')")
# Bytes of a line: 74 characters, one byte more where the flag has a character beyond ASCII, and the line end.
_LINE_BYTES = "75 + CASE WHEN l_orderkey % 5 = 0 OR l_orderkey % 17 = 0 THEN 1 ELSE 0 END"

ORACLE = {
    "archive_line_scan": _EXP,
    "archive_inventory": f"""SELECT 'lineitem/' || stem || '.zip' AS archive, stem || '.txt' AS text_members FROM ({_BLOCKS})
                             UNION ALL SELECT 'tampered/' || stem || '.zip', stem || '.txt' FROM ({_BLOCKS}) WHERE block % 5 = 0""",
    "file_listing": f"SELECT file, true AS is_zip FROM ({_FILES})",
    "unpack_rows": f"""SELECT 'lineitem/' || stem || '.zip' AS archive, stem || '.txt' AS member,
                              'lineitem/' || stem || '/' || stem || '.txt' AS output, CAST(NULL AS VARCHAR) AS error
                       FROM ({_BLOCKS})""",
    "verify_deep": f"""SELECT 'lineitem/' || stem || '.zip' AS key, 'ok' AS status FROM ({_BLOCKS})
                       UNION ALL SELECT 'tampered/' || stem || '.zip', 'failed' FROM ({_BLOCKS}) WHERE block % 5 = 0""",
    "dictionary_cells": f"""
        SELECT 'dict_' || CAST(doc_id AS VARCHAR) AS doc,
               row_number() OVER (PARTITION BY doc_id ORDER BY row_no) AS row_no, c0, c1, c2, c3, c4, c5, c6, c7
        FROM ({DQ._cell_rows()})""",
    "conversion_run": f"""
        SELECT 'mixed/' || stem || '.zip' AS source,
               CASE WHEN kind IN (0, 4, 5) THEN 'converted' ELSE 'unresolved' END AS status,
               CASE kind WHEN 1 THEN 'quantity' WHEN 2 THEN 'decoding' WHEN 3 THEN 'damaged' END AS reason,
               CASE WHEN kind IN (0, 5) THEN n WHEN kind = 4 THEN 0 END AS rows, stem || '.parquet' AS output
        FROM (SELECT printf('mixed_%05d', l_orderkey // {BLOCK}) AS stem, (l_orderkey // {BLOCK}) % 6 AS kind, count(*) AS n
              FROM lineitem GROUP BY 1, 2)""",
    "conversion_rows": f"""
        SELECT orderkey, partkey, linenumber, CAST(1 AS SMALLINT) AS quantity, extendedprice, flag, suppkey
        FROM ({FQ._EXPECTED.replace("SELECT", "SELECT (l_orderkey // " + str(BLOCK) + ") % 6 AS kind,", 1)}) WHERE kind IN (0, 5)""",
    "csv_one_column": f"SELECT coalesce(nullif(partkey, ''), '\"\"') AS value FROM ({FQ._TEXT})",
    "parquet_roundtrip": f"SELECT {FQ.COLUMNS} FROM ({_TYPED})",
    "csv_roundtrip": f"SELECT {FQ.COLUMNS} FROM ({_TEXT})",
    "conversion_order": f"""
        SELECT source, line_no, row_number() OVER (PARTITION BY source ORDER BY line_no) AS place
        FROM (SELECT 'lineitem_' || CAST(l_orderkey // {FQ.SOURCE_KEYS} AS VARCHAR) || '.parquet' AS source,
                     l_orderkey * 8 + l_linenumber AS line_no FROM lineitem)""",
    "conversion_tasks": "\nUNION ALL\n".join(f"""
        SELECT CAST({size} AS BIGINT) AS task_bytes, source, CAST(sum({_LINE_BYTES}) AS BIGINT) AS bytes,
               CAST(ceil(sum({_LINE_BYTES}) / {size}.0) AS BIGINT) AS blocks,
               CAST(floor((sum(sum({_LINE_BYTES})) OVER (ORDER BY source) - sum({_LINE_BYTES})) / {size}.0) AS BIGINT) AS first_task
        FROM (SELECT *, 'lineitem_' || CAST(l_orderkey // {FQ.SOURCE_KEYS} AS VARCHAR) || '.txt' AS source FROM lineitem)
        GROUP BY source""" for size in TASK_SIZES),
    "sorted_listing": f"""SELECT path, path_id, size, row_number() OVER (ORDER BY path, path_id) AS place FROM ({PQ.PATHS_SQL})""",
    "snapshot_state": """
        WITH y AS (SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, max(o_orderkey) AS last_key
                   FROM orders GROUP BY ALL)
        SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY year DESC) = 1""",
    "dataset_projection": f"SELECT orderkey, suppkey FROM ({_TYPED})",
    "dataset_filter": f"SELECT orderkey, extendedprice FROM ({_TYPED}) WHERE extendedprice >= 50000",
    "flat_index": f"""SELECT 'lineitem_' || CAST(l_orderkey // {FQ.SOURCE_KEYS} AS VARCHAR) || '.parquet' AS name,
                            'lineitem_' || CAST(l_orderkey // {FQ.SOURCE_KEYS} AS VARCHAR) || '.txt|layout:lineitem' AS files,
                            true AS has_bytes
                     FROM lineitem GROUP BY 1, 2""",
}
