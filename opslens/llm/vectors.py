"""Vectors as tables: checking, grouping exact copies, packing for tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable(vec: str):
    """True for a vector that is not null, has components, all of them finite, and not all zero."""
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def representatives(rows: DataFrame, ids: int | None = None) -> DataFrame:
    """Of rows (vec_id, v), one for each distinct v: vec_id (the smallest), v, copies, and, if asked for, members:
    the ``ids`` smallest vec_ids in order.

    Counting is combined before the shuffle, and the ranks are cut to ``ids`` before it too, so a vector that many
    rows share does not meet in one task.
    """
    key = rows.withColumn("_h", F.xxhash64("v"))
    counted = key.groupBy("_h", "v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    if ids is None:
        return counted.drop("_h")
    rank = F.row_number().over(W.partitionBy("_h", "v").orderBy("vec_id"))
    first = key.withColumn("_n", rank).filter(F.col("_n") <= ids).groupBy("_h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    return counted.join(first, ["_h", "v"]).drop("_h")


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = np.asarray(column.flatten(), dtype=dtype)
    return flat.reshape(n, -1) if n else np.empty((0, 0), dtype)


def rows_of(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as an Arrow column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel(), kind))


def lengths_agree(rows: DataFrame) -> int:
    """The common length of the vectors v, 0 without any; an error if they differ."""
    low, high = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} components cannot be compared")
    return low or 0
