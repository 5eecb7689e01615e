"""Keyed tables as versioned commits: blind upserts by any number of writers, read without their history.

A commit writes its rows to a folder of its own and then claims the next version by renaming a complete
log entry into place, which fails if another writer has that version; the loser takes the one
after it.  So no commit replaces another's rows, and what a reader lists is complete.  The row of a key is
that of its last version.  After ``compact_every`` commits the state is written as a base in key order; readers
start at the last base, and what lies before the one before it is removed.

The exclusive rename is atomic on HDFS and on stores whose connector offers it.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import archives as A
from .sinks import remove

VERSION = "_version"
COMPACT_EVERY = 16


class SnapshotTable:
    """Rows of ``schema`` (DDL, without maps) with one row for each ``key`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.key, self.compact_every = spark, A.qualified(spark, path), list(key), compact_every
        self.schema = T.StructType.fromDDL(schema)

    # ------------------------------------------------------------ log
    def _hadoop(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _log(self) -> list[int]:
        folder = self._hadoop("log")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _entry(self, version: int) -> tuple[str, str]:
        """``(kind, folder)`` of a version; kind is ``delta`` or ``base``."""
        entry = self._hadoop(f"log/{version:020d}")
        handle = entry.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(entry)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(handle, "UTF-8")
        finally:
            handle.close()
        kind, folder = text.split(" ")
        return kind, folder

    def _claim(self, version: int, kind: str, folder: str) -> bool:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        ready, entry = self._hadoop(f"log/_{uuid.uuid4().hex}"), self._hadoop(f"log/{version:020d}")
        fs = ready.getFileSystem(conf)
        out = fs.create(ready, False)
        out.write(bytearray(f"{kind} {folder}".encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(entry.toUri(), conf)
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(ready, entry, plain)
            return True
        except Exception as problem:  # noqa: BLE001 - the JVM's own type is known only by name here
            if "FileAlreadyExistsException" not in str(problem):
                raise
            fs.delete(ready, False)
            return False

    def _current(self, versions: list[int]) -> tuple[list[tuple[int, str]], str | None, int | None]:
        """Deltas after the last base, that base's folder and its version."""
        deltas = []
        for version in reversed(versions):
            kind, folder = self._entry(version)
            if kind == "base":
                return deltas, folder, version
            deltas.append((version, folder))
        return deltas, None, None

    # ---------------------------------------------------------- state
    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _state(self, versions: list[int]) -> DataFrame:
        deltas, base, _ = self._current(versions)
        names = self.schema.fieldNames()
        old = self.spark.read.schema(self.schema).parquet(f"{self.path}/{base}") if base else self._empty()
        if not deltas:
            return old
        rows = old.withColumn(VERSION, F.lit(-1).cast("long"))
        for version, folder in deltas:
            delta = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
            rows = rows.unionByName(delta.withColumn(VERSION, F.lit(version).cast("long")))
        order = F.struct(VERSION, F.xxhash64(*names))
        last = rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in self.key]).agg(F.max_by(F.struct(*names), order).alias("row"))
        return last.select("row.*")

    def read(self) -> DataFrame:
        """The row of every key: of its last commit, and of several in one commit always the same one."""
        return self._state(self._log())

    def version(self) -> int:
        """The last version, -1 if there is none."""
        return max(self._log(), default=-1)

    # --------------------------------------------------------- writers
    def commit(self, rows: DataFrame) -> int:
        """Add or replace the rows of their keys; returns the version."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.option(
            "compression", "zstd").parquet(f"{self.path}/{folder}")
        version = self.version() + 1
        while not self._claim(version, "delta", folder):
            version += 1
        deltas, _, _ = self._current(self._log())
        if len(deltas) >= self.compact_every:
            self.compact()
        return version

    def compact(self) -> bool:
        """Write the state as a base, in key order; False (and nothing changed) if another writer came first."""
        versions = self._log()
        if not versions:
            return False
        _, _, before = self._current(versions)
        folder = f"data/{uuid.uuid4().hex}"
        self._state(versions).orderBy(*self.key).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        if not self._claim(versions[-1] + 1, "base", folder):
            remove(self.spark, f"{self.path}/{folder}")
            return False
        # A reader that listed the log before this base may still need the one before it and what follows that.
        for version in versions:
            if before is not None and version < before:
                _, unused = self._entry(version)
                remove(self.spark, f"{self.path}/log/{version:020d}")
                remove(self.spark, f"{self.path}/{unused}")
        return True
