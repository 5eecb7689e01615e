"""Incremental conversion of arriving fixed-width files with Structured Streaming.

The file stream source remembers in its checkpoint which files it has already
read, which is exactly the "convert only what is new" contract of the batch
conversion plan, without a manifest of our own.  Each micro-batch is handled
in ``foreachBatch``: records of sources with a bad record are diverted to a
``rejected`` table (one row per source) and every other record is written to
the output, partitioned by batch and source.  A replayed batch replaces what
it wrote before.

``maxFilesPerTrigger`` bounds the size of a micro-batch; ``availableNow``
processes the backlog and stops, which is how a scheduled job uses it.
"""

from __future__ import annotations

import hashlib
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.layout import Layout
from ..session import checkpoint_root, ship_package, staging_path
from ..sources.fixed_width import ERRORS, parse_lines


def stream_lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir).select(F.col("_metadata.file_path").alias("source"), F.col("value"))


def stream_fixed_width(
    spark: SparkSession, input_dir: str, layout: Layout, columns: Iterable[str] | None = None,
    all_string: bool = False, max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming typed scan: same projection as the batch scan."""
    return parse_lines(stream_lines(spark, input_dir, max_files_per_trigger), layout, columns, all_string,
                       keep=["source"])


def _sink(output_dir: str, rejected_dir: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch replaces the folder of its number, so its rows are never there twice.
        staged = staging_path(batch.sparkSession, f"stream-{batch_id}")
        batch.write.parquet(staged)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(staged)
        bad = rows.filter(F.col(ERRORS) != "").groupBy("source").agg(
            F.count(F.lit(1)).alias("bad_rows"), F.min(ERRORS).alias("first_error"))
        bad.write.mode("overwrite").parquet(f"{rejected_dir}/_batch={batch_id}")
        known = batch.sparkSession.read.schema(bad.schema).parquet(f"{rejected_dir}/_batch={batch_id}")
        clean = rows.join(known.select("source"), "source", "left_anti").drop(ERRORS)
        clean.write.mode("overwrite").partitionBy("source").parquet(f"{output_dir}/_batch={batch_id}")

    return write_batch


def _stream_name(input_dir: str, output_dir: str) -> str:
    """The same in every process, so that a later run finds the checkpoint of an earlier one."""
    return hashlib.sha256(f"{input_dir}\n{output_dir}".encode()).hexdigest()[:24]


def start_conversion(
    spark: SparkSession, input_dir: str, layout: Layout, output_dir: str,
    checkpoint: str | None = None, columns: Iterable[str] | None = None, all_string: bool = False,
    max_files_per_trigger: int | None = 100, available_now: bool = True,
) -> StreamingQuery:
    """Start (or resume) the incremental conversion of ``input_dir``."""
    ship_package(spark)
    parsed = stream_fixed_width(spark, input_dir, layout, columns, all_string, max_files_per_trigger)
    location = checkpoint or f"{checkpoint_root(spark)}/wavefold-streams/{_stream_name(input_dir, output_dir)}"
    writer = parsed.writeStream.foreachBatch(_sink(output_dir, output_dir.rstrip("/") + "_rejected")) \
        .option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
