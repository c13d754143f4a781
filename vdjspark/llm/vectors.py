"""What the operators on embeddings share: which vectors take part, and their entries as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and holds numbers only."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def usable(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(key, v) of the finite vectors, and their length; where lengths differ, only of the most frequent one (of equals the longest). Without any, 0."""
    good = rows.select(F.col(key).cast("long").alias(key), F.col(vector).alias("v")).filter(finite(F.col("v")))
    found = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = found[0]["d"] if found else 0
    return good.filter(F.size("v") == d), d


def matrix(batch: pa.RecordBatch, column: str, d: int, kind: type = np.float64) -> np.ndarray:
    """A column of lists of d numbers, as rows."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(kind)
