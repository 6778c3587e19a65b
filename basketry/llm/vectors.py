"""Vector columns: which rows are usable, their names, and their values as matrices in Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where the vector is not null and holds neither a null nor a non-finite component."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, entry), F.lit(False))


def name(*columns: Column) -> Column:
    """A 128-bit name (32 hex digits) of the columns' values; equal values have equal names."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *columns)), 16, "0") for seed in (17, 71)])


def matrix(column: pa.Array | pa.ChunkedArray, dtype: type = np.float64) -> np.ndarray:
    """Rows of equally long lists without nulls as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0), dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)
