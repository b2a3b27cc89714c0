"""Vectors as rows: which take part, and exact arithmetic in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _usual_size(vectors: DataFrame, vec_col: str) -> int:
    """The commonest number of components (the smaller of two as common), 0 without vectors."""
    top = (vectors.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count()
           .orderBy(F.desc("count"), "d").first())
    return top.d if top else 0


def usable(vec: Column, size: int) -> Column:
    """True where a vector has ``size`` components, all finite, and is not zero."""
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    some = F.exists(vec, lambda x: x != 0)
    return F.coalesce((F.size(vec) == size) & finite & some, F.lit(False))


def as_doubles(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of the vectors that take part, components as doubles."""
    size = _usual_size(vectors, vec_col)
    return (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col), size))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")))


def matrix(column: pa.Array, size: int | None = None) -> np.ndarray:
    """An Arrow list column without nulls as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, size or 0))


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(rows.reshape(-1)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, each summed in the same order whatever stands beside it."""
    return (a * b).sum(axis=1)
