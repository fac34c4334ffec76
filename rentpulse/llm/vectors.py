"""Reading embedding columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector takes part: not NULL, no NULL or non-finite component, not all zero."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.empty((0, 0))


def directions(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; safe for very large and very small components."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
