"""Which vectors take part in comparisons, and arrays of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column | str) -> Column:
    """Whether a vector is not null, empty or zero and holds finite numbers only."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
