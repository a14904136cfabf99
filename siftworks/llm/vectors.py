"""Reading embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", kind: str = "array<double>") -> DataFrame:
    """(vec_id, v): rows whose vector is neither null nor zero and has finite components only."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    some = F.exists(v, lambda x: x != 0)
    good = F.when(v.isNotNull() & (F.size(v) > 0), finite & some).otherwise(False)
    return vectors.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.cast(kind).alias("v"))


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
