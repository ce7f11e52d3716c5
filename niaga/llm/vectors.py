"""Reading of embedding columns: which vectors take part, and their exact cosine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Whether the vector is an array of finite numbers that are not all zero, with a norm that a double holds."""
    largest = 1.7976931348623157e308
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= largest))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.coalesce(v.isNotNull() & finite & (norm > 0) & (norm <= largest), F.lit(False))


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None) -> DataFrame:
    """(vec_id, v array<double>[, label]); all other columns are left out."""
    label = [F.col(label_col).cast("string").alias("label")] if label_col else []
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), *label)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(rows, dimensions) of a column of vectors of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))
