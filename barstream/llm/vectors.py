"""Vectors of a table: which take part, how Arrow columns become matrices, and centres of a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values (rows times dimension) that the sample for centres holds at most: 16,384 vectors of 64.
SAMPLE_VALUES = 1 << 20
ROUNDS = 8  # of the centres' refinement


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null, NaN or infinite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def rows_of(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column, which may differ in length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.diff(column.offsets.to_numpy()))
    return np.split(values, ends[:-1]) if len(column) else []


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def vector_sample(rows: DataFrame, id_col: str, vector_col: str) -> list[tuple[int, np.ndarray]]:
    """At most ``SAMPLE_VALUES`` values of the vectors whose ids hash lowest: the same for any partitioning."""
    longest = rows.agg(F.max(F.size(vector_col))).first()[0]
    if longest is None:
        return []
    picked = rows.select(id_col, vector_col).orderBy(F.xxhash64(id_col), id_col).limit(max(SAMPLE_VALUES // longest, 1))
    return [(row[0], np.array(row[1], np.float64)) for row in picked.collect()]


def fit_centres(vectors: np.ndarray, count: int, spherical: bool = False) -> np.ndarray:
    """At most ``count`` centres of the rows of ``vectors``; ``spherical``: unit vectors by largest cosine."""
    if spherical:
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = vectors[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    centres = np.unique(vectors, axis=0)
    if len(centres) > count:
        centres = centres[np.random.default_rng(5).choice(len(centres), count, replace=False)]
        for _ in range(ROUNDS):
            own = nearest_centre(vectors, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, vectors)
            sizes = np.bincount(own, minlength=len(centres))
            centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
            if spherical:
                norms = np.linalg.norm(centres, axis=1, keepdims=True)
                centres = centres / np.where(norms > 0, norms, 1)
    return centres


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each row the centre at the least distance."""
    return np.argmin((centres ** 2).sum(axis=1) - 2 * (vectors @ centres.T), axis=1)
