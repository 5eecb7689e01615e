"""Session helpers: building a local session and locating shared staging space.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private directory is set up only when the
session has none, which is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("wavefold")
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that names none is accepted only on a ``local`` master, where the
    driver and the tasks share one disk: a private folder is then registered
    with the context and reused by every later call.  On a cluster such a
    folder would be visible to one machine only, so the call fails instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = _LOCAL_ROOTS.get(context.applicationId)
    if not root:
        root = tempfile.mkdtemp(prefix="wavefold-ckpt-")
        context.setCheckpointDir(root)
        _LOCAL_ROOTS[context.applicationId] = root
    return root


_LOCAL_ROOTS: dict[str, str] = {}


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/wavefold-stage/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it read back (lineage ends here)."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``wavefold`` importable in Python workers (``--py-files`` style).

    Functions run by ``mapInPandas``/``applyInPandas`` refer to this package;
    the package is zipped once per application and added with ``addPyFile``,
    so workers import it whatever their working directory.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(package)
    fd, path = tempfile.mkstemp(prefix="wavefold-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(package):
            if "__pycache__" in folder:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    _SHIPPED.add(key)
