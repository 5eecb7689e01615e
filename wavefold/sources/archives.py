"""ZIP archives as tables.

ZIPs do not split, so every function here runs one archive per task inside
``mapInPandas`` and reads it through a random-access file handle: the
inventory and member choice read only the central directory, the line scan
streams one member and emits bounded batches, the CRC check streams every
member.  Callers repartition the line table before heavy work.

Paths are the URIs Spark reports (``file:/…``, ``hdfs://…``, ``s3a://…``);
task-side I/O goes through ``pyarrow.fs`` so the same code runs on a cluster.
"""

from __future__ import annotations

import io
import os
import posixpath
import shutil
import uuid
import zipfile
import zlib
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..session import ship_package

LINE_BATCH = 50_000
COPY_BYTES = 1 << 20
# What reading a damaged archive raises: structure, deflate data, early end, unknown methods.
DAMAGED = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError, KeyError)

INVENTORY_SCHEMA = "archive string, size long, mtime timestamp, readable boolean, members array<string>, error string"
LINES_SCHEMA = "archive string, member string, line_no long, value string, error string, offset long"
CRC_SCHEMA = "archive string, crc_ok boolean, bad_member string"
UNPACK_SCHEMA = "archive string, member string, output string, bytes long, error string"


# ----------------------------------------------------------- file access


def filesystem(uri: str):
    """(pyarrow filesystem, path) for a Spark-style URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return fs.LocalFileSystem(), path
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _local_path(uri: str) -> str | None:
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return path
    return None if "://" in uri else uri


def open_random_access(uri: str):
    """A seekable binary handle.  Local files use the built-in ``open`` (no
    native thread pool inside forked Python workers); other schemes go through
    ``pyarrow.fs``."""
    local = _local_path(uri)
    if local is not None:
        return open(local, "rb")
    fs_, path = filesystem(uri)
    return fs_.open_input_file(path)


def open_new(uri: str):
    """A binary handle on a new file; its folder is made as needed."""
    local = _local_path(uri)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    fs_, path = filesystem(uri)
    fs_.create_dir(posixpath.dirname(path), recursive=True)
    return fs_.open_output_stream(path)


def write_bytes(uri: str, data: bytes) -> None:
    with open_new(uri) as out:
        out.write(data)


def write_whole(uri: str, data: bytes) -> None:
    """``write_bytes`` by way of a hidden file of its own beside ``uri``: what is at ``uri`` is whole at any time."""
    folder, name = posixpath.split(uri)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_bytes(aside, data)
    local = _local_path(aside)
    if local is not None:
        os.replace(local, _local_path(uri))
        return
    fs_, path = filesystem(uri)
    if exists(uri):
        fs_.delete_file(path)
    fs_.move(filesystem(aside)[1], path)


def exists(uri: str) -> bool:
    from pyarrow import fs

    fs_, path = filesystem(uri)
    return fs_.get_file_info(path).type != fs.FileType.NotFound


def replace_folder(source: str, target: str) -> None:
    """Move ``source`` into the place of ``target``.  A repeated attempt that finds its work done changes nothing."""
    fs_, src = filesystem(source)
    _, dst = filesystem(target)
    if not exists(source):
        if exists(target):
            return
        raise OSError(f"neither {source} nor {target} is there")
    fs_.create_dir(posixpath.dirname(dst), recursive=True)
    aside = f"{dst.rstrip('/')}.old"
    if exists(target):
        if exists(f"{target.rstrip('/')}.old"):
            fs_.delete_dir(aside)
        fs_.move(dst, aside)
    fs_.move(src, dst)
    if exists(f"{target.rstrip('/')}.old"):
        fs_.delete_dir(aside)


def copy_folder(source: str, target: str) -> None:
    """Put a copy of the (small) folder ``source`` in the place of ``target``."""
    from pyarrow import fs

    fs_, src = filesystem(source)
    part = f"{target.rstrip('/')}.part"
    for info in fs_.get_file_info(fs.FileSelector(src)):
        if info.is_file and not info.base_name.startswith("."):
            with fs_.open_input_stream(info.path) as stream, open_new(f"{part}/{info.base_name}") as out:
                shutil.copyfileobj(stream, out, COPY_BYTES)
    replace_folder(part, target)


def is_empty_folder(spark: SparkSession, root: str) -> bool:
    """Whether no data file is below ``root`` (Spark's own marker files do not count)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs_ = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return not any(not s.getPath().getName().startswith(("_SUCCESS", ".")) for s in fs_.listStatus(path))


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme of the session's default file system, so that a task opens the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def is_text_member(name: str) -> bool:
    return not name.endswith("/") and name.lower().endswith((".txt", ".dat"))


# -------------------------------------------------------------- listing


def file_listing(spark: SparkSession, root: str, zips_only: bool = False) -> DataFrame:
    """Every file below ``root`` with size and modification time.

    Uses the binary-file source without its ``content`` column, so no file is
    read; any case of ``.zip`` is accepted when ``zips_only``.
    """
    df = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    )
    if zips_only:
        df = df.filter(P.zip_suffix(F.col("path")))
    return df


# ------------------------------------------------------------ inventory


def _inventory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        mtimes = pdf["mtime"] if "mtime" in pdf.columns else [None] * len(pdf)
        for uri, size, mtime in zip(pdf["path"], pdf["size"], mtimes):
            try:
                with open_random_access(uri) as handle, zipfile.ZipFile(handle) as archive:
                    names = archive.namelist()
                out.append((uri, int(size), mtime, True, names, None))
            except DAMAGED as exc:
                out.append((uri, int(size), mtime, False, [], f"damaged archive: {exc}"))
        yield pd.DataFrame(out, columns=["archive", "size", "mtime", "readable", "members", "error"])


def archive_inventory(listing: DataFrame) -> DataFrame:
    """Member names of every archive (central directory only) plus the text
    members; unreadable archives are kept with ``readable = false`` so the
    caller can warn and skip them."""
    ship_package(listing.sparkSession)
    if "mtime" not in listing.columns:
        listing = listing.withColumn("mtime", F.lit(None).cast("timestamp"))
    inv = listing.select("path", "size", "mtime").mapInPandas(_inventory, INVENTORY_SCHEMA)
    return inv.withColumn("text_members", F.filter("members", P.is_text_member))


# ------------------------------------------------------------ line scan


def _split_lines(handle, encoding: str) -> Iterator[tuple[str | None, str | None]]:
    text = io.TextIOWrapper(handle, encoding=encoding, errors="strict", newline="")
    try:
        for line in text:
            if line.endswith("\r\n"):
                line = line[:-2]
            elif line.endswith(("\n", "\r")):
                line = line[:-1]
            yield line, None
    except UnicodeDecodeError as exc:
        yield None, f"{exc.reason} while reading as {encoding}"


def _line_scan(member: str | None, encoding: str, batch_rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            members = pdf["member"] if "member" in pdf.columns else [None] * len(pdf)
            for uri, own in zip(pdf["path"], members):
                rows: list[tuple] = []
                try:
                    with open_random_access(uri) as handle, zipfile.ZipFile(handle) as archive:
                        chosen = own or member
                        if chosen is None:
                            candidates = [n for n in archive.namelist() if is_text_member(n)]
                            if len(candidates) != 1:
                                yield pd.DataFrame(
                                    [(uri, None, None, None, f"{len(candidates)} text members where one is needed", 0)],
                                    columns=["archive", "member", "line_no", "value", "error", "offset"])
                                continue
                            chosen = candidates[0]
                        with archive.open(chosen) as stream:
                            offset = 0
                            for number, (value, error) in enumerate(_split_lines(stream, encoding), start=1):
                                rows.append((uri, chosen, number, value, error, offset))
                                offset += len(value or "") + 1
                                if len(rows) >= batch_rows:
                                    yield pd.DataFrame(rows, columns=["archive", "member", "line_no", "value", "error", "offset"])
                                    rows = []
                except DAMAGED as exc:
                    rows.append((uri, member, None, None, f"damaged archive: {exc}", 0))
                if rows:
                    yield pd.DataFrame(rows, columns=["archive", "member", "line_no", "value", "error", "offset"])

    return run


def archive_lines(archives: DataFrame, member: str | None = None, encoding: str = "utf-8",
                  batch_rows: int = LINE_BATCH) -> DataFrame:
    """``archive, member, line_no, value, error, offset`` for the text member of each
    archive: the one named in a ``member`` column or by ``member``, else the
    only ``.txt``/``.dat`` one.

    ``\\n``, ``\\r\\n`` and ``\\r`` all end a line, decoding is strict; a
    decode error ends that archive with an ``error`` row.  ``line_no`` is the
    1-based position in the member — a stable ordinal for ties — and ``offset``
    the characters before the line, never more than the bytes before it.
    """
    ship_package(archives.sparkSession)
    given = [c for c in ("path", "member") if c in archives.columns]
    return archives.select(*given).mapInPandas(_line_scan(member, encoding, batch_rows), LINES_SCHEMA)


def _member_bytes(member: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            members = pdf["member"] if "member" in pdf.columns else [None] * len(pdf)
            out = []
            for uri, own in zip(pdf["path"], members):
                try:
                    with open_random_access(uri) as handle, zipfile.ZipFile(handle) as archive:
                        infos = {i.filename: i.file_size for i in archive.infolist()}
                    chosen = own or member
                    out.append((uri, infos.get(chosen, 0) if chosen else max([infos[n] for n in infos if is_text_member(n)], default=0)))
                except DAMAGED:
                    out.append((uri, 0))
            yield pd.DataFrame(out, columns=["path", "bytes"])

    return run


def member_bytes(archives: DataFrame, member: str | None = None) -> DataFrame:
    """``path, bytes``: uncompressed size of the text member that ``archive_lines`` reads (central directory only; 0 if it cannot be read)."""
    ship_package(archives.sparkSession)
    given = [c for c in ("path", "member") if c in archives.columns]
    return archives.select(*given).mapInPandas(_member_bytes(member), "path string, bytes long")


# -------------------------------------------------------------- digests


DIGEST_SCHEMA = "path string, file_size long, digest string, error string"


def _digests(chunk_size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            out = []
            for uri in pdf["path"]:
                digest, size = hashlib.sha256(), 0
                try:
                    with open_random_access(uri) as handle:
                        while True:
                            chunk = handle.read(chunk_size)
                            if not chunk:
                                break
                            digest.update(chunk)
                            size += len(chunk)
                    out.append((uri, size, digest.hexdigest(), None))
                except OSError as exc:
                    out.append((uri, None, None, str(exc)))
            yield pd.DataFrame(out, columns=["path", "file_size", "digest", "error"])

    return run


def file_digests(listing: DataFrame, chunk_size: int = 1 << 20) -> DataFrame:
    """SHA-256 of every listed file, streamed in 1 MiB chunks inside tasks
    (no 2 GiB row limit, bounded memory), one file per loop iteration."""
    ship_package(listing.sparkSession)
    return listing.select("path").mapInPandas(_digests(chunk_size), DIGEST_SCHEMA)


# ---------------------------------------------------------------- CRC


def _crc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for uri in pdf["path"]:
            try:
                with open_random_access(uri) as handle, zipfile.ZipFile(handle) as archive:
                    bad = archive.testzip()
                out.append((uri, bad is None, bad))
            except DAMAGED as exc:
                out.append((uri, False, f"damaged archive: {exc}"))
        yield pd.DataFrame(out, columns=["archive", "crc_ok", "bad_member"])


def crc_check(archives: DataFrame) -> DataFrame:
    """Deep check: every member's CRC, one archive per task."""
    ship_package(archives.sparkSession)
    return archives.select("path").mapInPandas(_crc, CRC_SCHEMA)


# --------------------------------------------------------------- unpack


def _unpack(target_root: str, strip_prefix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uri, relative in zip(pdf["path"], pdf["relative"]):
                rows = []
                base = posixpath.join(target_root.rstrip("/"), posixpath.splitext(relative)[0])
                try:
                    with open_random_access(uri) as handle, zipfile.ZipFile(handle) as archive:
                        infos = [i for i in archive.infolist() if not i.is_dir()]
                        unsafe = [i.filename for i in infos if _unsafe(i.filename)]
                        if unsafe:
                            rows.append((uri, unsafe[0], None, None, "unsafe member"))
                        else:
                            for info in infos:
                                name = info.filename.replace("\\", "/")
                                out_uri = posixpath.join(base, name)
                                with archive.open(info) as stream, open_new(out_uri) as out:
                                    shutil.copyfileobj(stream, out, COPY_BYTES)
                                rows.append((uri, name, out_uri, info.file_size, None))
                except DAMAGED as exc:
                    rows.append((uri, None, None, None, f"damaged archive: {exc}"))
                yield pd.DataFrame(rows, columns=["archive", "member", "output", "bytes", "error"])

    return run


def _unsafe(name: str) -> bool:
    norm = name.replace("\\", "/")
    return norm.startswith("/") or ".." in norm.split("/") or (len(norm) > 1 and norm[1] == ":")


def unpack_archives(archives: DataFrame, target_root: str, relative_col: str = "relative") -> DataFrame:
    """Write every member of each archive below ``target_root/<archive
    without .zip>/``; an unsafe member fails its whole archive and nothing of
    it is written.  Rewrites are idempotent, so a retried task is harmless."""
    ship_package(archives.sparkSession)
    return archives.select("path", F.col(relative_col).alias("relative")).mapInPandas(
        _unpack(target_root, ""), UNPACK_SCHEMA)


# ------------------------------------------------------------- fixtures


def zip_bytes(members: list[tuple[str, bytes]]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", compression=zipfile.ZIP_DEFLATED) as archive:
        for name, data in members:
            archive.writestr(name, data)
    return buffer.getvalue()
