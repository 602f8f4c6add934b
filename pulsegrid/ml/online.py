"""Linear regression trained by micro-batches.

Each batch makes a few gradient steps from the weights the previous batch left; a step is one sum of
one vector over the batch, for all models and features. Weights are one
small row per batch and model; a repeated batch starts from the same row and replaces its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import dot
from pulsegrid.ml.blocks import Block, sum_blocks
from pulsegrid.session import folder_names

WEIGHTS = "model string, weights array<double>, rows bigint, mse double, rmse double"


class OnlineRegression:
    """Several models (name -> step size) trained side by side on batches with ``label`` and ``features``."""

    def __init__(self, spark: SparkSession, path: str, n_features: int, steps: dict[str, float], iterations: int = 1):
        self.spark, self.path, self.n_features = spark, path, n_features
        self.steps, self.iterations = dict(steps), iterations

    def history(self) -> DataFrame:
        return self.spark.read.schema(f"{WEIGHTS}, batch_id bigint").parquet(self.path)

    def weights_before(self, batch_id: int) -> dict[str, list[float]]:
        """Weights that the newest earlier batch left; only its folder is read."""
        done = [int(name.removeprefix("batch_id=")) for name in folder_names(self.spark, self.path) if name.startswith("batch_id=")]
        earlier = [n for n in done if n < batch_id]
        found = {name: [0.0] * self.n_features for name in self.steps}
        if earlier:
            last = self.spark.read.schema(WEIGHTS).parquet(f"{self.path}/batch_id={max(earlier)}")
            found |= {row.model: list(row.weights) for row in last.collect()}  # one row per model
        return found

    def train_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Score the batch with the weights before it, train on it, store metrics and new weights."""
        sparse = dict(batch.dtypes)["features"].startswith("struct")
        kind = "struct<indices:array<int>,values:array<double>>" if sparse else "array<double>"
        points = batch.select(F.col("label").cast("double"), F.col("features").cast(kind)).persist()
        try:
            names, n = list(self.steps), 0
            before = self.weights_before(batch_id)
            weights = np.array([before[name] for name in names])
            steps = np.array([[self.steps[name]] for name in names])
            mse = [None] * len(names)
            for i in range(1, self.iterations + 1):
                sums = self._sums(points, weights)
                if sums is None:  # the weights carry on, so that the next batch finds them
                    break
                n = round(sums[-1])
                if i == 1:
                    mse = [float(x) / n for x in sums[-1 - len(names) : -1]]
                weights = weights - steps / i**0.5 / n * sums[: -1 - len(names)].reshape(weights.shape)
            rows = [(m, w.tolist(), n, e, None if e is None else e**0.5) for m, w, e in zip(names, weights, mse)]
            self.spark.createDataFrame(rows, WEIGHTS).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        finally:
            points.unpersist()

    def _sums(self, points: DataFrame, weights: np.ndarray) -> np.ndarray | None:
        """Gradients and squared errors of all models, and the number of points: one sum of one vector."""
        width = self.n_features

        def of_batch(batch: pa.RecordBatch) -> np.ndarray:
            block = Block(batch.column("features"), width)
            error = block.times(weights) - batch.column("label").to_numpy(zero_copy_only=False)[:, None]
            return np.concatenate((block.weighted(error).ravel(), (error**2).sum(0), [block.rows]))

        return sum_blocks(points, of_batch)

    def start(self, stream: DataFrame, checkpoint: str):
        return (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(self.train_batch)
            .trigger(availableNow=True)
            .start()
        )

    def predict(self, points: DataFrame, model: str) -> DataFrame:
        last = self.history().filter(F.col("model") == model).orderBy(F.desc("batch_id")).limit(1).first()
        return points.withColumn("prediction", dot("features", F.array(*[F.lit(float(x)) for x in last.weights])))


def labelled_lines(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """``y<TAB>x1,...,xn`` text lines to ``label`` and ``features``."""
    parts = F.split(F.col(payload), "\t")
    features = F.transform(F.split(parts[1], ","), lambda x: x.cast("double"))
    return lines.select(parts[0].cast("double").alias("label"), features.alias("features"))


def purchase_lines(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """``user,product,price`` text lines."""
    parts = F.split(F.col(payload), ",")
    return lines.select(
        parts[0].alias("user"), parts[1].alias("product"), parts[2].cast("double").alias("price")
    )
