"""Shared pieces of the operators on integer vectors: usable rows, blocks of equal length, whole-number components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 4096


def finite(column: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers (true for an empty vector)."""
    each = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & each, F.lit(False))


def measured(vectors: DataFrame, *columns: str) -> DataFrame:
    """The rows with a finite vector: ``columns``, ``embedding`` and its length ``dim``."""
    return vectors.filter(finite()).select(*columns, "embedding", F.size("embedding").alias("dim"))


def lengths(rows: DataFrame) -> list[int]:
    """The vector lengths that occur, ascending."""
    return sorted(row["dim"] for row in rows.select("dim").distinct().collect())


def by_length(batches: Iterator[pa.RecordBatch], size: int = BATCH) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of at most ``size`` rows, each of one vector length."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            dims = part.column("dim").to_numpy()
            found = np.unique(dims).tolist()
            for dim in found:
                yield dim, part if len(found) == 1 else part.filter(pa.array(dims == dim))


def whole(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * component)`` of each vector as 64-bit integers; a component beyond 2^53 is an error."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.floor(flat * scale).reshape(len(column), dim)
    if flat.size and np.abs(flat).max() >= 2.0 ** 53:
        raise ValueError(f"components times {scale} exceed 2^53")
    return flat.astype(np.int64)
