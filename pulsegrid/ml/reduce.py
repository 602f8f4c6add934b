"""Principal components and the singular value decomposition of a vector column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from pulsegrid.ml.blocks import Block
from pulsegrid.ml.features import standardiser, vector_of
from pulsegrid.session import written

#: Triangles that one task of the tree stacks, in expectation.
TREE_FAN = 16


def pca_projection(df: DataFrame, k: int, vector: str = "embedding"):
    """Fitted pipeline (centring, then PCA) and the rows with their ``projection`` array."""
    data = df.withColumn("raw", vector_of(vector))
    stages = [standardiser("raw", "centred", with_std=False), PCA(k=k, inputCol="centred", outputCol="pcs")]
    model = Pipeline(stages=stages).fit(data)
    projected = model.transform(data).withColumn("projection", vector_to_array("pcs"))
    return model, projected.drop("raw", "centred", "pcs")


def component_rows(model, spark) -> DataFrame:
    """Explained variance share and loadings of each component."""
    pca = model.stages[-1]
    loadings = pca.pc.toArray().T.tolist()
    shares = pca.explainedVariance.toArray().tolist()
    rows = [(i + 1, float(s), [float(x) for x in l]) for i, (s, l) in enumerate(zip(shares, loadings))]
    return spark.createDataFrame(rows, "component int, share double, loadings array<double>")


@dataclass
class Svd:
    """Centred rows X of a table as X = U diag(values) axes, with ``axes`` one row per component.

    The entry of an axis with the largest absolute value is positive, so that signs are the same on every run.
    """

    rows: int
    mean: np.ndarray
    values: np.ndarray
    axes: np.ndarray


def _triangle(stack: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stack, mode="r")


def _triangles(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Per task, the triangle R of its rows with a leading column of ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((0, width + 1)), 0
        for batch in batches:
            if batch.num_rows:
                x = Block(batch.column(0), width).dense
                r, n = _triangle(np.vstack((r, np.column_stack((np.ones(len(x)), x))))), n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    rows = df.select(F.col(vector).cast("array<double>").alias("x"))
    return rows.mapInArrow(run, "n long, r array<double>")


def centred_svd(df: DataFrame, k: int, vector: str = "embedding") -> Svd:
    """The ``k`` largest singular values of the mean-centred rows, their axes, and the mean.

    A tree of QR factorisations: each task reduces its rows to a triangle, triangles are stacked and
    reduced again until one is left, and only that one reaches the driver. A leading column of ones
    takes the mean out: what is below its row is the triangle of the centred rows.
    """
    first = df.select(F.size(vector).alias("w")).first()
    if first is None:
        raise ValueError("an empty table has no axes")
    width = first.w
    tree = written(_triangles(df, vector, width), "triangles")

    def merge(table: pa.Table) -> pa.Table:
        r = _triangle(np.vstack([np.array(x).reshape(-1, width + 1) for x in table.column("r").to_pylist()]))
        return pa.table({"n": [sum(table.column("n").to_pylist())], "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    while (count := tree.count()) > 1:
        groups = -(-count // TREE_FAN) if count > 2 * TREE_FAN else 1
        numbered = tree.withColumn("g", F.pmod(F.xxhash64("n", "r"), F.lit(groups)))
        tree = written(numbered.groupBy("g").applyInArrow(merge, "n long, r array<double>"), "triangles")
    last = tree.first()
    r = np.array(last.r).reshape(-1, width + 1)
    _, values, axes = np.linalg.svd(r[1:, 1:])
    values = np.concatenate((values, np.zeros(width - len(values))))[:k]
    axes = axes[:k]
    sign = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])
    return Svd(last.n, r[0, 1:] / r[0, 0], values, axes * sign[:, None])


def svd_rows(spark: SparkSession, svd: Svd) -> DataFrame:
    """Singular value and axis of each component."""
    rows = [(i + 1, float(s), [float(x) for x in v]) for i, (s, v) in enumerate(zip(svd.values, svd.axes))]
    return spark.createDataFrame(rows, "component int, singular_value double, axis array<double>")


def left_vectors(df: DataFrame, svd: Svd, vector: str = "embedding") -> DataFrame:
    """The rows with ``u``, their row of U; a component without spread is 0. U diag(values) is the projection on the axes."""
    scale = np.divide(1.0, svd.values, out=np.zeros_like(svd.values), where=svd.values > 1e-12 * max(1.0, svd.values.max(initial=0.0)))
    schema = StructType([*df.schema, StructField("u", ArrayType(DoubleType()))])
    at = df.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = Block(batch.column(at).cast(pa.list_(pa.float64())), len(svd.mean)).dense
            u = ((x - svd.mean) @ svd.axes.T) * scale
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(u), pa.list_(pa.float64()))], names=[*batch.schema.names, "u"])

    return df.mapInArrow(run, schema)


def singular_values(df: DataFrame, k: int, vector: str = "embedding") -> DataFrame:
    """Top-k singular values of the mean-centred rows."""
    return svd_rows(df.sparkSession, centred_svd(df, k, vector)).select("component", "singular_value")
