"""What the two vector operators share."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is not null, holds finite numbers only, and is not zero."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@cache
def planes(dimension: int, number: int, seed: int) -> np.ndarray:
    """Normals of random hyperplanes, one per column."""
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, number))


@cache
def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random rotation."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimension]).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of unit length, and their lengths; very large and small components don't overflow."""
    top = np.abs(x).max(1, keepdims=True)
    unit = x / top
    norm = np.sqrt((unit * unit).sum(1, keepdims=True))
    return unit / norm, (norm * top)[:, 0]
