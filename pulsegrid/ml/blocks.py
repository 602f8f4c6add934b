"""Numeric work on whole Arrow batches inside tasks, and sums of vectors across tasks.

A feature column is an array of doubles, or a struct of ``indices`` (array of int) and ``values``
(array of double) for wide rows that are mostly zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: First-level sums; the second level adds up this many vectors.
SUM_GROUPS = 64


class Block:
    """The rows of a batch as a matrix of ``width`` columns, dense or as entries of sparse rows."""

    def __init__(self, column: pa.Array, width: int) -> None:
        self.rows, self.width = len(column), width
        self.dense = None
        if pa.types.is_struct(column.type):
            indices, values = column.field("indices"), column.field("values")
            self.index = _flat(indices).astype(np.int64)
            self.value = _flat(values)
            self.row = np.repeat(np.arange(self.rows), np.diff(indices.offsets.to_numpy()))
        else:
            self.dense = _flat(column).reshape(self.rows, width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Products with each of the weight vectors: rows x models."""
        if self.dense is not None:
            return self.dense @ weights.T
        return np.column_stack([np.bincount(self.row, self.value * w[self.index], self.rows) for w in weights])

    def weighted(self, factors: np.ndarray) -> np.ndarray:
        """Sums of the rows, each by its factor (rows x models): models x width."""
        if self.dense is not None:
            return factors.T @ self.dense
        return np.stack([np.bincount(self.index, self.value * f[self.row], self.width) for f in factors.T])


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float)


def sum_blocks(points: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """Sum over all rows of a vector that ``of_batch`` computes from a batch; None for an empty table.

    A task adds up its batches to one vector; the vectors of the tasks are added in two levels inside
    Spark, so that no task and not the driver holds more than a few of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(batch).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total], pa.list_(pa.float64()))})

    parts = points.mapInArrow(run, "sums array<double>").select(array_to_vector("sums").alias("v"), F.spark_partition_id().alias("p"))
    level = parts.groupBy(F.pmod("p", F.lit(SUM_GROUPS))).agg(Summarizer.sum(F.col("v")).alias("v"))
    found = level.groupBy(F.lit("all")).agg(Summarizer.sum(F.col("v")).alias("v")).first()  # no row for an empty table
    return None if found is None else found["v"].toArray()
