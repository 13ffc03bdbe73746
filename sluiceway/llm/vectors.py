"""Vectors scaled to whole numbers, so that inner products and their ties are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import col

#: Vectors whose squared length reaches this take no part: sums of their products may not fit 64 bits.
LARGEST = 2.0**57


def squared_length(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))


def whole_vectors(rows: DataFrame, factor: int, *others: str) -> DataFrame:
    """``vec_id``, the named columns, and ``v``: ``floor(factor * x)`` of every component ``x`` as a double.

    Rows with a null id take no part, nor do vectors that are null, empty, hold null or non-finite components, or are
    too long for exact sums (:data:`LARGEST`). Wholly equal rows count once; they are combined before the shuffle.
    """
    x = F.transform(col("embedding"), lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    scaled = F.when((F.size(x) > 0) & fine, F.transform(x, lambda e: F.floor(F.lit(float(factor)) * e)))
    named = rows.select(col("vec_id").cast("long").alias("vec_id"), *[col(o).alias(o) for o in others], scaled.alias("v"))
    kept = named.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(squared_length(F.col("v")) < LARGEST)
    return kept.distinct()


def common_length(vectors: DataFrame) -> tuple[int, int, float] | None:
    """The most frequent length (ties: the shorter), how many vectors have it, and their largest squared length."""
    told = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(squared_length(F.col("v"))).alias("top"))
    first = told.orderBy(F.desc("n"), "d").limit(1).collect()
    return (first[0]["d"], first[0]["n"], first[0]["top"]) if first else None


def number_type(top: float, width: int) -> type:
    """Doubles where sums over products stay exact in them (and are quicker), else 64-bit integers."""
    return np.float64 if top * width < 2.0**53 else np.int64


def matrix(vectors: pa.Array, kind: type) -> np.ndarray:
    """Equally long vectors of an Arrow list column as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(vectors), -1)
