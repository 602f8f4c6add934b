"""Sorting, rankings and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import word_tokens
from pulsegrid.operators.filters import Conditions, condition_filter


def sort_messages(df: DataFrame, key: str, ties: list[str] | None = None, ascending: bool = True) -> DataFrame:
    """Total order over a range shuffle; ``ties`` lets a large tie spread over several partitions."""
    first = F.asc(key) if ascending else F.desc(key)
    return df.orderBy(first, *(ties or []))


def rank_by_count(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Keys by number of rows, most first; equal counts by key. Only the ``top`` rows are kept when given."""
    ranked = df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(key))
    return ranked.limit(top) if top else ranked


def rank_by_sum(df: DataFrame, key: str, target: str, top: int | None = None) -> DataFrame:
    ranked = df.groupBy(key).agg(F.sum(target).alias("total")).orderBy(F.desc("total"), F.asc(key))
    return ranked.limit(top) if top else ranked


def rank_report(df: DataFrame, key: str, target: str, conditions: Conditions, top: int) -> DataFrame:
    """First ``top`` keys by count and by amount among the rows that meet the conditions."""
    totals = condition_filter(df, conditions).groupBy(F.col(key).cast("string").alias("key")).agg(
        F.count("*").alias("n"), F.sum(target).alias("total")
    )
    scores = F.array(
        F.struct(F.lit("count").alias("ranking"), F.col("n").alias("score")),
        F.struct(F.lit("amount").alias("ranking"), F.col("total").alias("score")),
    )
    both = totals.select("key", F.inline(scores)).select("ranking", "key", "score")
    return top_per_group(both, ["ranking"], [F.desc("score"), F.asc("key")], top).drop("rank")


def top_k(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps only ``k``."""
    return df.orderBy(*order).limit(k)


def top_words(df: DataFrame, text: str, k: int, pattern: str = r"\s+") -> DataFrame:
    words = df.select(F.explode(word_tokens(text, pattern)).alias("word"))
    return rank_by_count(words, "word", k)


#: Spark limits a group before the shuffle up to this rank only.
GROUP_LIMIT = 1000


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], k: int, name: str = "rank", salts: int = 64) -> DataFrame:
    """First ``k`` rows of each group. Spark limits each group to ``k`` rows before the shuffle, so a
    hot group never meets in one task. Beyond Spark's limit a group is ranked in ``salts`` parts first,
    and only the first ``k`` rows of each part meet."""
    if k > GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id()), F.lit(salts)))
        part = F.row_number().over(Window.partitionBy(*groups, "_salt").orderBy(*order))
        df = salted.withColumn("_part", part).filter(F.col("_part") <= k).drop("_salt", "_part")
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)


def user_top_items(ratings: DataFrame, items: DataFrame, user: int, k: int) -> DataFrame:
    """Best-rated products of one user with their titles; ``items`` has ``product`` and ``title``."""
    best = top_k(ratings.filter(F.col("user") == user), [F.desc("rating"), F.asc("product")], k)
    return best.join(items, "product")


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))
