"""Vectors as exact integers of any size, for the operators that compare them.

A component x becomes floor(scale * x). Integers below 2^62 are int64; where a result might
not fit, the same steps run on Python integers (numpy object arrays), which never overflow.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST = 2 ** 63 - 2  # results beyond it (in size) are shown as it


def is_finite(vector: Column) -> Column:
    """True where the vector is there and all its components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of numbers, without NULLs, as float64 rows of `width`; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(np.diff(column.offsets.to_numpy()))
    sizes = np.diff(np.r_[0, ends])
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
    return out


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64, or Python integers if one of them needs more than 62 bits."""
    if not x.size or np.abs(x).max() < 2.0 ** 62 / scale:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) * scale if abs(v) >= 2.0 ** 53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return out


def largest(x: np.ndarray) -> int:
    """The greatest size of an entry, as a Python integer."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def rows_above(x: np.ndarray, bound: int) -> np.ndarray:
    """Which rows have an entry of a size above `bound`."""
    return ((x > bound) | (x < -bound)).astype(bool).any(axis=1)


def parted(x: np.ndarray, bound: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The row numbers and rows within `bound` (as int64), then those above it; empty parts are left out."""
    above = rows_above(x, bound)
    out = []
    if not above.all():
        out.append((np.flatnonzero(~above), x[~above].astype(np.int64)))
    if above.any():
        out.append((np.flatnonzero(above), x[above].astype(object)))
    return out


def as_long(x: np.ndarray) -> np.ndarray:
    """Integers of any size as int64, those that do not fit as the nearest of +-LARGEST."""
    if x.dtype == np.int64:
        return np.clip(x, -LARGEST, LARGEST)
    return np.array([max(-LARGEST, min(LARGEST, int(v))) for v in x.ravel()], np.int64).reshape(x.shape)
