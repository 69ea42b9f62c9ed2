"""What both vector operators share: which vectors take part, and a column of lists as a matrix."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def usable(column: str) -> F.Column:
    """Not null, not empty, no null, NaN or infinite component, and not all zero."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & ~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
