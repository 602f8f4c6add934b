"""Recommendation from rating triples (user, product, rating)."""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import cosine_similarity
from pulsegrid.ml.search import best_items


#: Ratings that a task of the factor model orders and keeps at once.
BLOCK_RATINGS = 1 << 22


def train_als(ratings: DataFrame, rank: int = 50, iterations: int = 10, reg: float = 0.01, seed: int = 1) -> ALSModel:
    """Factor model of stored ratings. Its blocks, ten by default, get more with the ratings, not larger; each starts from
    random factors of its own, so the factors depend on their number."""
    blocks = max(10, math.ceil(ratings.count() / BLOCK_RATINGS))
    als = ALS(
        userCol="user", itemCol="product", ratingCol="rating", rank=rank, maxIter=iterations, regParam=reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks
    )
    return als.setColdStartStrategy("drop").fit(ratings)


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    return model.transform(pairs.select("user", "product"))


def recommend(model: ALSModel, users: DataFrame, k: int, titles: DataFrame | None = None) -> DataFrame:
    """Top ``k`` products of the given users as (user, rank, product, score), with titles when given."""
    recs = _flat(model.recommendForUserSubset(users.select("user").distinct(), k))
    return recs.join(titles, "product") if titles is not None else recs


def recommend_all(model: ALSModel, k: int) -> DataFrame:
    """Top ``k`` products of every user as (user, rank, product, score): exact search that leaves out products too short to count."""
    return best_items(model.userFactors, model.itemFactors, k)


def _flat(recs: DataFrame) -> DataFrame:
    return recs.select("user", F.posexplode("recommendations").alias("pos", "r")).select(
        "user", (F.col("pos") + 1).alias("rank"), F.col("r.product").alias("product"), F.col("r.rating").alias("score")
    )


def similar_items(items: DataFrame, item_id: int, k: int, id_col: str = "id", vector: str = "features") -> DataFrame:
    """The ``k`` rows closest to one row by cosine; the row itself is included with similarity 1.

    Only the one query vector travels to the tasks, and each task keeps its best ``k``.
    """
    query = items.filter(F.col(id_col) == item_id).select(F.col(vector).cast("array<double>").alias("q")).first()
    if query is None:
        raise KeyError(item_id)
    wanted = F.array(*[F.lit(float(x)) for x in query.q])
    scored = items.select(id_col, cosine_similarity(vector, wanted).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), F.asc(id_col)).limit(k)


def rating_errors(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """MSE and RMSE of predictions joined to ratings on (user, product)."""
    joined = actual.select("user", "product", "rating").join(
        predicted.select("user", "product", "prediction"), ["user", "product"]
    )
    squared = (F.col("rating") - F.col("prediction")) * (F.col("rating") - F.col("prediction"))
    return joined.agg(F.avg(squared).alias("mse"), F.sqrt(F.avg(squared)).alias("rmse"), F.count("*").alias("n"))


def _precision_sums(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per user of ``predicted``: sum over hits of hits-so-far / rank, hits, and distinct products owned.

    Owned products meet the ranks in a join on (user, product); only the ranks of a user meet in a window.
    """
    owned = actual.select("user", "product").distinct()
    sizes = owned.groupBy("user").agg(F.count("*").alias("n_actual"))
    ranked = predicted.select("user", "product", "rank")
    hits = ranked.join(owned.withColumn("hit", F.lit(1)), ["user", "product"], "left").fillna(0, ["hit"])
    upto = F.sum("hit").over(Window.partitionBy("user").orderBy("rank"))
    scores = hits.withColumn("part", F.when(F.col("hit") == 1, upto / F.col("rank")).otherwise(0.0))
    summed = scores.groupBy("user").agg(F.sum("part").alias("score"), F.sum("hit").cast("long").alias("hits"))
    return summed.join(sizes, "user", "left")


def average_precision(actual: DataFrame, predicted: DataFrame, k: int) -> DataFrame:
    """AP@k per user of ``predicted``: ranked products against the distinct products the user has.

    The sum over hits is divided by min(number of products owned, k). A user who owns none scores 1.
    """
    sums = _precision_sums(actual, predicted.filter(F.col("rank") <= k))
    value = F.when(F.col("n_actual").isNull(), F.lit(1.0)).otherwise(
        F.col("score") / F.least(F.col("n_actual"), F.lit(k))
    )
    return sums.select("user", "hits", value.alias("average_precision"))


def mean_average_precision(actual: DataFrame, predicted: DataFrame, k: int) -> DataFrame:
    return average_precision(actual, predicted, k).agg(
        F.avg("average_precision").alias("mean_average_precision"), F.count("*").alias("users")
    )


def ranking_map(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Mean average precision of whole rankings: divided by all products owned, over users who own some."""
    sums = _precision_sums(actual, predicted).filter(F.col("n_actual").isNotNull())
    return sums.agg(F.avg(F.col("score") / F.col("n_actual")).alias("ranking_map"))
