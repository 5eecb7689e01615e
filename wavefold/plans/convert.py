"""Conversion: fixed-width lines → typed Parquet or raw-text CSV, per source.

One Spark job parses and writes every source that shares a layout, once,
partitioned by source and by the first fault of a record.  A source whose
folder holds nothing but fault-free rows is published; one with an unreadable
archive, an undecodable line or a bad field is ``unresolved`` with its reason,
and its rows go with the staging folder.  A source without lines is published
as an empty table with the schema.

Tasks and files follow the bytes of the sources, not a setting: a source is cut
into blocks of ``task_bytes`` of text, and the blocks of all sources in order
are dealt out to as many tasks as their bytes fill (``plan_blocks``).  Task
numbers grow with the block, so the part files of an output sort in line order.
Blocks much smaller than ``BUNDLE_BYTES`` share tasks once there are many of
them, as a shuffle has a piece for each pair of tasks; such a task cuts its
files by their number of rows, and they are numbered in line order too.  As
Parquet these many small files are written by ``_write_small``, which returns
their rows and faults, so that nothing lists or opens them again.

The set of sources comes from the caller, not from what was written, so every
source is accounted for.  Publishing is a Spark job too: each task moves the
folders of its sources, and the driver handles no per-source state.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from typing import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import Layout
from ..operators.ordered import running_total
from ..session import ship_package, staged
from ..sources import archives as A
from ..sources.fixed_width import ERRORS, parse_lines
from .sinks import CSV_OPTIONS, remove

# Text of one task, and so of one output file at most.
TASK_BYTES = 128 << 20
# Text of a task that holds several smaller blocks, and blocks for each core before any share a task.
BUNDLE_BYTES = 16 << 20
CORE_BLOCKS = 16
# Sources up to which their blocks are sent to every task, some 100 bytes each.
SENT_SOURCES = 200_000
_CLEAN = "__HIVE_DEFAULT_PARTITION__"
_MAX_FAULT_CHARS = 80
_COUNTS = pa.schema([("_src", pa.string()), ("_fault", pa.string()), ("n", pa.int64())])
# Sorts before any field name: that a source cannot be read explains what else is wrong with it.
_UNREADABLE = "! "


def default_output(source: Column, output_format: str) -> Column:
    """File name of the source with its suffix replaced by the format."""
    name = F.regexp_extract(source, r"([^/]*)/*$", 1)
    return F.concat(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.lit("." + output_format))


def convert_lines(
    spark: SparkSession,
    lines: DataFrame,
    layout: Layout,
    target_root: str,
    output_format: str = "parquet",
    columns: Iterable[str] | None = None,
    all_string: bool = False,
    force: bool = False,
    sources: DataFrame | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Convert ``lines`` (``source, value``; optional ``line_no``, ``place``, ``offset``, ``error``) and publish one directory per source.

    ``sources`` lists what is to be converted: ``source`` and optionally
    ``output`` (relative to ``target_root``; default: ``default_output``) and
    ``bytes`` (text of the source; without it, or without the lines' ``offset``, one pass over the
    lines adds them up).  With ``line_no`` the rows of an output keep the order of the lines, across its files too,
    and with ``place`` those that share a number keep the order of theirs.
    Without ``sources`` they are those that have lines.  An ``error`` row marks
    its source as unreadable.  Returns the report ``source, rows, failed,
    first_error, status, output``; ``status`` is ``converted``,
    ``unresolved``, or ``exists`` for an output that was there before
    (without ``force``; its source is not read).
    """
    if output_format not in ("parquet", "csv"):
        raise ValueError("output_format must be 'parquet' or 'csv'")
    ship_package(spark)
    root = target_root.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex[:12]}"
    names = [v.name for v in layout.select(columns)]
    measured = None
    if sources is None and "line_no" in lines.columns:
        # The pass that finds the sources also adds up their bytes.
        measured = staged(_measured(lines), "convert-sizes")
    plan = sources if sources is not None else (measured if measured is not None else lines).select("source").distinct()
    if "output" not in plan.columns:
        plan = plan.withColumn("output", default_output(F.col("source"), output_format))
    # The files of small blocks are cut by rows, which the pass over the lines counts.
    known = "bytes" in plan.columns and "offset" in lines.columns and task_bytes >= BUNDLE_BYTES
    plan = plan.select("source", F.concat(F.lit(root + "/"), "output").alias("output"), _folder(F.col("source")).alias("_src"),
                       (F.col("bytes") if known else F.lit(None)).cast("long").alias("bytes"))
    plan = staged(plan.mapInPandas(_with_presence, "source string, output string, _src string, bytes long, present boolean"), "convert-plan")
    if not force:
        done = plan.filter("present")
        if not done.isEmpty():
            lines = lines.join(done.select("source"), "source", "left_anti")
            measured = measured.join(done.select("source"), "source", "left_anti") if measured is not None else None

    file_rows = 0
    try:
        if "line_no" in lines.columns:
            if known:
                sizes = plan.filter(F.lit(force) | ~F.col("present")).select("source", "bytes")
            else:
                sizes = measured if measured is not None else _measured(lines)
            blocks = staged(plan_blocks(sizes, task_bytes).withColumn("_src", _folder(F.col("source"))), "convert-blocks")
            lines, file_rows = in_blocks(lines, blocks, task_bytes)
        written = _rendered(lines, layout, names, output_format, all_string)
        if file_rows and output_format == "parquet":
            found = _write_small(written, staging, file_rows)
        else:
            _write(written, names, output_format, staging, file_rows)
            found = _found(spark, written, staging, output_format)
        report = plan.join(found, "_src", "left").select(
            "source", "_src", F.coalesce("rows", F.lit(0)).alias("rows"), F.col("first_error").isNotNull().alias("failed"),
            "first_error",
            F.when(F.col("present") & F.lit(not force), "exists").when(F.col("first_error").isNotNull(), "unresolved")
            .otherwise("converted").alias("status"), "output")
        report = staged(report, "convert-report")
        _publish(report.filter("status = 'converted'"), staging, output_format, _empty_output(spark, written, staging, output_format))
    finally:
        remove(spark, staging)
    return report.drop("_src")


def _folder(source: Column) -> Column:
    """A partition value that needs no escaping and never looks like a number to a reader."""
    return F.concat(F.lit("s"), F.substring(F.sha2(source, 256), 1, 32))


def _measured(lines: DataFrame) -> DataFrame:
    """``source, bytes, n`` from the lines themselves."""
    text = F.octet_length(F.coalesce("value", F.lit("").cast(lines.schema["value"].dataType))) + 1
    return lines.groupBy("source").agg(F.sum(text).alias("bytes"), F.max("line_no").alias("n"), F.min("line_no").alias("low"),
                                       F.count(F.lit(1)).alias("lines"))


def plan_blocks(sizes: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``source, bytes, first_task, blocks``: the tasks that the text of ``sizes(source, bytes)`` fills.

    A source has a block for each ``task_bytes`` it begins, one at least, in tasks that follow one another; a source begins in the task
    that the bytes of those before it (by name) have reached.  So a task holds less than twice ``task_bytes``, small sources
    share tasks and a source of any size is as many files as its bytes need.
    """
    size = F.greatest(F.coalesce("bytes", F.lit(0)), F.lit(1)).cast("long")
    placed = running_total(sizes.withColumn("bytes", size), ["source"], F.col("bytes"), "_start")
    return placed.withColumn("first_task", F.floor(F.col("_start") / task_bytes)).withColumn(
        "blocks", F.ceil(F.col("bytes") / task_bytes)).drop("_start")


def in_blocks(lines: DataFrame, blocks: DataFrame, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """``lines`` with ``_src``, dealt out so that each task is one partition, tasks in order of source and line; rows of a file.

    A line's block comes from its ``offset``, else from its share of the source's lines.  Rows of a file are 0 (no limit) unless
    tasks hold several blocks; then they are as many as fill ``task_bytes`` on average.
    """
    counted = "lines" in blocks.columns
    found = blocks.agg(F.max(F.col("first_task") + F.col("blocks")), F.count(F.lit(1)), F.sum("bytes"), F.sum("lines" if counted else F.lit(0))).first()
    tasks, sources, text, rows = (x or 1 for x in found)
    cores = lines.sparkSession.sparkContext.defaultParallelism
    shared = max(1, min(BUNDLE_BYTES // task_bytes, tasks // (CORE_BLOCKS * cores))) if counted else 1
    if "offset" in lines.columns and "n" not in blocks.columns:
        at = F.floor(F.coalesce("offset", F.lit(0)) / task_bytes)
    else:
        at = F.floor(F.coalesce(F.col("line_no") - F.col("low"), F.lit(0)) * F.col("blocks") / (F.col("n") - F.col("low") + 1))
    block = F.least(F.greatest(at, F.lit(0)), F.col("blocks") - 1)
    of = blocks.drop("bytes", "lines").withColumnRenamed("source", "_of")
    placed = lines.join(F.broadcast(of) if sources <= SENT_SOURCES else of, F.col("source") == F.col("_of"))
    task = F.floor((F.col("first_task") + block) / shared).cast("int")
    dealt = placed.select(*lines.columns, "_src", task.alias("_task")).repartitionById(math.ceil(tasks / shared), F.col("_task"))
    return dealt, max(1, task_bytes * rows // text) if shared > 1 else 0


def _with_presence(batches):
    for pdf in batches:
        yield pdf.assign(present=[A.exists(uri) for uri in pdf["output"]])[["source", "output", "_src", "bytes", "present"]]


def _rendered(lines: DataFrame, layout: Layout, names: list[str], output_format: str, all_string: bool) -> DataFrame:
    """``_src, _fault`` and the fields of the lines, in the order in which a task writes them."""
    if "_src" not in lines.columns:
        lines = lines.withColumn("_src", _folder(F.col("source")))
    # A field may have any name, also one of these.
    own = {c: f"_line_{c}" for c in ("_src", "line_no", "place", "error") if c in lines.columns}
    # CSV is raw trimmed text: only decoding is checked, nothing is typed.
    parsed = parse_lines(lines.withColumnsRenamed(own), layout, names, all_string or output_format == "csv", keep=list(own.values()))
    fault = F.when(F.col(ERRORS) != "", F.substring_index(ERRORS, ",", 1))
    if "error" in own:
        fault = F.coalesce(F.concat(F.lit(_UNREADABLE), F.substring(own["error"], 1, _MAX_FAULT_CHARS)), fault)
    order = [own[c] for c in ("line_no", "place") if c in own] if "line_no" in own else []
    marked = parsed.select(F.col(own["_src"]).alias("_src"), fault.alias("_fault"), *order, *names)
    if order:
        marked = marked.sortWithinPartitions("_src", "_fault", *order)
    return marked.select("_src", "_fault", *names)


def _write(out: DataFrame, names: list[str], output_format: str, staging: str, file_rows: int = 0) -> None:
    writer = out.write.partitionBy("_src", "_fault").option("maxRecordsPerFile", file_rows)
    if output_format == "parquet":
        writer.option("compression", "zstd").parquet(staging)
    else:
        options = CSV_OPTIONS
        if len(names) == 1:
            # An empty value alone on its line would be a blank line, which readers skip: it is written
            # as "".  The values are quoted here, so the writer must not quote them again.
            options = CSV_OPTIONS | {"sep": "\u0001", "quote": "\u0000", "escape": "\u0000"}
            writer = out.withColumn(names[0], _quoted(F.col(names[0]))).write.partitionBy("_src", "_fault").option("maxRecordsPerFile", file_rows)
        for key, value in options.items():
            writer = writer.option(key, value)
        writer.csv(staging)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that share ``_src`` and ``_fault``, with the two."""
    ends = [pc.run_end_encode(batch.column(c)).run_ends.to_numpy() for c in ("_src", "_fault")]
    start = 0
    for end in np.union1d(*ends).tolist():
        yield (batch.column("_src")[start].as_py(), batch.column("_fault")[start].as_py()), batch.slice(start, end - start)
        start = end


def _write_small(out: DataFrame, staging: str, file_rows: int) -> DataFrame:
    """Write ``out`` as Parquet files of ``file_rows`` rows; rows and first fault of each source.

    Folders and names are those of Spark's writer, without its work for each file in the task and once more in the driver.  A file
    appears whole and has the same name in every attempt of its task, so a task that is run again replaces what it had written.
    """
    stem = str(uuid.uuid4())

    def run(batches):
        import pyarrow.parquet as pq

        task = TaskContext.get().partitionId()
        key, number, held, rows, total = None, 0, [], 0, 0

        def put():
            nonlocal number, held, rows
            table = pa.Table.from_batches([b.drop_columns(["_src", "_fault"]) for b in held])
            # Like Spark's writer: every column may hold nulls.
            table = table.cast(pa.schema([f.with_nullable(True).remove_metadata() for f in table.schema]))
            data = pa.BufferOutputStream()
            pq.write_table(table, data, compression="zstd", store_schema=False)
            src, fault = key
            # Rejected rows go with the staging folder: nothing reads the name of theirs.
            kind = _CLEAN if fault is None else hashlib.sha1(fault.encode("utf-8", "surrogateescape")).hexdigest()
            A.write_whole(f"{staging}/_src={src}/_fault={kind}/part-{task:05d}-{stem}.c{number:03d}.zstd.parquet", data.getvalue())
            number, held, rows = number + 1, [], 0

        def ended():
            if rows:
                put()
            return pa.RecordBatch.from_pylist([{"_src": key[0], "_fault": key[1], "n": total}], _COUNTS)

        for batch in batches:
            for found, part in _runs(batch) if batch.num_rows else ():
                if found != key:
                    if key is not None:
                        yield ended()
                    key, number, total = found, 0, 0
                total += part.num_rows
                while part.num_rows:
                    taken = part.slice(0, file_rows - rows)
                    held.append(taken)
                    rows += taken.num_rows
                    part = part.slice(taken.num_rows)
                    if rows == file_rows:
                        put()
        if key is not None:
            yield ended()

    counts = staged(out.mapInArrow(run, "_src string, _fault string, n long"), "convert-files")
    return _by_source(counts)


def _quoted(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit('""')).when(value.rlike('[,"\r\n]'), quoted).otherwise(value)


def _found(spark: SparkSession, written: DataFrame, staging: str, output_format: str) -> DataFrame:
    """Rows and first fault of each staged source."""
    if A.is_empty_folder(spark, staging):
        return spark.createDataFrame([], "_src string, rows long, first_error string")
    if output_format == "parquet":
        counts = spark.read.schema(written.schema).parquet(staging).groupBy("_src", "_fault").agg(F.count(F.lit(1)).alias("n"))
    else:
        # A field holds no line end, so a file has a line for each row and one for the header.
        schema = "value string, _src string, _fault string"
        files = spark.read.schema(schema).option("lineSep", "\r\n").text(staging)
        counts = files.groupBy("_src", "_fault", "_metadata.file_path").agg((F.count(F.lit(1)) - 1).alias("n"))
    return _by_source(counts)


def _by_source(counts: DataFrame) -> DataFrame:
    first = F.regexp_replace(F.min("_fault"), f"^{_UNREADABLE}", "")
    return counts.groupBy("_src").agg(F.sum("n").alias("rows"), first.alias("first_error"))


def _empty_output(spark: SparkSession, written: DataFrame, staging: str, output_format: str) -> str:
    """A folder with an empty table of the output's schema, for sources without lines."""
    path = f"{staging}/_empty"
    empty = spark.createDataFrame([], written.drop("_src", "_fault").schema).coalesce(1)
    if output_format == "parquet":
        empty.write.parquet(path)
    else:
        writer = empty.write
        for key, value in CSV_OPTIONS.items():
            writer = writer.option(key, value)
        writer.csv(path)
    return path


def _publish(report: DataFrame, staging: str, output_format: str, empty: str) -> None:
    def run(batches):
        for pdf in batches:
            for src, rows, target in zip(pdf["_src"], pdf["rows"], pdf["output"]):
                if rows:
                    A.replace_folder(f"{staging}/_src={src}/_fault={_CLEAN}", target)
                else:
                    A.copy_folder(empty, target)
            yield pdf[["output"]]

    moved = report.select("_src", "rows", "output").repartition(F.col("_src")).mapInPandas(run, "output string")
    moved.write.format("noop").mode("overwrite").save()
