"""KMeans on vector columns."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import portable_bucket, squared_distance
from pulsegrid.ml.features import vector_of
from pulsegrid.operators.ranking import top_per_group
from pulsegrid.session import durable


def fit_kmeans(df: DataFrame, k: int, iterations: int = 20, seed: int = 1, vector: str = "embedding") -> KMeansModel:
    data = df.withColumn("features", vector_of(vector))
    return KMeans(k=k, maxIter=iterations, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)


def assign(df: DataFrame, model: KMeansModel, vector: str = "embedding") -> DataFrame:
    """Cluster of each row and its squared distance to the centre (the k centres are a literal map)."""
    placed = model.transform(df.withColumn("features", vector_of(vector)))
    return with_distance(placed, [c.tolist() for c in model.clusterCenters()], vector).drop("features")


def with_distance(df: DataFrame, centers: list[list[float]], vector: str, cluster: str = "cluster") -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]  # k rows
    table = F.broadcast(df.sparkSession.createDataFrame(rows, "_i int, _centre array<double>"))
    near = df.join(table, F.col(cluster) == F.col("_i")).withColumn("distance", squared_distance(vector, "_centre"))
    return near.drop("_i", "_centre")


def assign_to(df: DataFrame, centers: list[list[float]], vector: str = "embedding") -> DataFrame:
    """Cluster and squared distance by given centres (k literals); ties to the first."""
    distances = F.array(*[squared_distance(vector, F.array(*[F.lit(float(x)) for x in c])) for c in centers])
    placed = df.withColumn("_d", distances).withColumn("distance", F.array_min("_d"))
    return placed.withColumn("cluster", (F.array_position("_d", F.col("distance")) - 1).cast("int")).drop("_d")


def distance_to_mean(df: DataFrame, cluster: str = "cluster", vector: str = "embedding") -> DataFrame:
    """Squared distance of each row to the mean vector of its given cluster."""
    means = df.groupBy(cluster).agg(Summarizer.mean(vector_of(vector)).alias("m"))
    centres = means.select(cluster, vector_to_array("m").alias("centre"))
    return df.join(centres, cluster).withColumn("distance", squared_distance(vector, "centre")).drop("centre")


def nearest_members(assigned: DataFrame, id_col: str, k: int = 20) -> DataFrame:
    return top_per_group(assigned, ["cluster"], [F.asc("distance"), F.asc(id_col)], k)


def cluster_cost(assigned: DataFrame) -> DataFrame:
    """Within-cluster sum of squares."""
    return assigned.agg(F.sum("distance").alias("cost"))


def cost_by_k(df: DataFrame, id_col: str, ks: list[int], iterations: int = 10, vector: str = "embedding") -> DataFrame:
    """Held-out cost for each k on a fixed 60/40 split."""
    split = df.withColumn("share", portable_bucket(id_col, 10, 123))
    train, test = split.filter("share < 6"), split.filter("share >= 6")
    train.persist()
    try:
        rows = [
            (k, float(cluster_cost(assign(test, fit_kmeans(train, k, iterations, vector=vector), vector)).first().cost))
            for k in ks
        ]
    finally:
        train.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")
