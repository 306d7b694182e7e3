"""Vectors as packed rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not NULL, not empty, and every component present and finite."""
    finite = F.forall(
        column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & finite, F.lit(False))


def matrix(packed: pa.Array | list, kind: str) -> np.ndarray:
    """Rows of equal length from a column of binary values."""
    values = packed.to_pylist() if isinstance(packed, (pa.Array, pa.ChunkedArray)) else packed
    width = len(values[0]) // np.dtype(kind).itemsize if values else 0
    return np.frombuffer(b"".join(values), kind).reshape(len(values), width)

