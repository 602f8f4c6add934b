"""Work per micro-batch: counts, SQL, arbitrary functions, unions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import word_tokens

__all__ = ["batch_counts", "batch_sql", "batch_size", "batch_words", "union_streams"]


def batch_counts(key: str) -> Callable[[DataFrame, int], DataFrame]:
    """Rows per key of each batch on its own."""
    return lambda batch, _: batch.groupBy(key).agg(F.count("*").alias("n"))


def batch_size() -> Callable[[DataFrame, int], DataFrame]:
    """Number of records of each batch."""
    return lambda batch, _: batch.agg(F.count("*").alias("n"))


def batch_words(text: str) -> Callable[[DataFrame, int], DataFrame]:
    def count(batch: DataFrame, _: int) -> DataFrame:
        return batch.select(F.explode(word_tokens(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))

    return count


def batch_sql(view: str, query: str) -> Callable[[DataFrame, int], DataFrame]:
    """Run SQL against each batch under a view name."""

    def run(batch: DataFrame, _: int) -> DataFrame:
        batch.createOrReplaceTempView(view)
        return batch.sparkSession.sql(query)

    return run


def union_streams(*streams: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)
