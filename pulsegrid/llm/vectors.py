"""Vectors of a table as rows of integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has entries and all of them are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def scaled(df: DataFrame, vector: str, scale: int, *keep: Column) -> DataFrame:
    """The columns in keep and x, the vector as array<long> of floor(scale * entry); rows without a usable vector go."""
    wide = df.select(*keep, F.col(f"`{vector}`").cast("array<double>").alias("_v")).filter(usable(F.col("_v")))
    return wide.withColumn("x", F.transform("_v", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))).drop("_v")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The lists, all of the same length, as rows."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(lists) or (len(lists) and (np.diff(lists.offsets.to_numpy()) != width).any()):
        raise ValueError(f"the vectors have different lengths; the first has {width} entries")
    return flat.reshape(len(lists), width)


def width_of(vectors: DataFrame) -> int:
    """Entries of the first vector, 0 if there is none."""
    row = vectors.select(F.size("x").alias("n")).first()
    return row.n if row else 0


def product_fits(*factors: int) -> bool:
    """Whether the product of the bounds is exact in 64 bits."""
    p = 1
    for f in factors:
        p *= int(f)
    return p < 1 << 62
