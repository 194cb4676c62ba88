"""Vectors as whole numbers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256


def is_whole(vector: Column) -> Column:
    """Whether the vector and all its entries are there and finite."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_vectors(df: DataFrame, vector_col: str, *kept: Column) -> DataFrame:
    """The ``kept`` columns and ``x``, each entry ``c`` as ``floor(256 c)``, of the rows whose vector is whole."""
    vector = F.col(f"`{vector_col}`")
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return df.where(is_whole(vector)).select(*kept, scaled.alias("x"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Arrays of longs as the rows of a matrix; shorter ones are filled up with zeros."""
    values, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(values) == width * len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out
