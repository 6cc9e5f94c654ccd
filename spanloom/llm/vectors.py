"""Vectors of numbers as columns and as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only; never null."""
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(F.forall(vector, sound), F.lit(False))


def matrix(vectors: pa.Array, kind: pa.DataType, width: int) -> np.ndarray:
    """Vectors of length ``width`` as rows of a matrix."""
    flat = pc.list_flatten(vectors).cast(kind).to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), width)
