"""Vector columns: expressions for single rows, NumPy views for Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l1", "l2")


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two array<double> columns."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def distance(a: Column | str, b: Column | str, metric: str = "l1") -> Column:
    """L1 or L2 distance of two array<double> columns."""
    check_metric(metric)
    if metric == "l1":
        gaps = F.zip_with(a, b, lambda x, y: F.abs(x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x))


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")


def matrix(column: pa.ListArray) -> np.ndarray:
    """A batch of equally long vectors as a (rows, dims) array, without a copy.

    Rows of other lengths would shift all that follow, so they and NULLs are errors.
    """
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or (len(lengths) and (lengths != lengths[0]).any()) or column.values.null_count:
        raise ValueError("vectors must have one length and no NULL")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_vectors(rows: np.ndarray) -> pa.ListArray:
    """A (rows, dims) array as an Arrow array<double> column."""
    n, dims = rows.shape
    offsets = np.arange(0, n * dims + 1, dims, dtype=np.int32) if dims else np.zeros(n + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows, dtype=float).ravel()))


def gaps(points: np.ndarray, target: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every row of `points` to one vector."""
    difference = points - target
    if metric == "l1":
        return np.abs(difference).sum(axis=1)
    return np.sqrt(np.einsum("ij,ij->i", difference, difference))
