"""Row position, per-partition work, samples and layout."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import durable


def row_index(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Adds the 0-based position of each row in the given order.

    The sort is a range shuffle. Its partitions are fixed by a checkpoint, one small count per
    partition gives the offsets, and no task sees more than its own partition. Give an order
    that is unique, so that a large tie can be split between partitions.
    """
    placed = durable(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part, local = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    # one row per partition of the sorted data
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_o"))
    numbered = placed.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    return numbered.withColumn(name, F.col("_o") + local).drop("_p", "_o", "_m")


def slice_totals(df: DataFrame, key: str, slices: int, value: str) -> DataFrame:
    """Count and sum of a column in each of ``slices`` slices of the keys."""
    return df.groupBy(F.pmod(F.col(key), F.lit(slices)).alias("slice")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total")
    )


def tagged_partitions(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows tagged with the number of the range partition they were placed in.

    The other columns break ties, so that a hot key fills several partitions instead of one.
    """
    ties = [c for c in df.columns if c != key]
    return df.repartitionByRange(parts, key, *ties).withColumn("partition", F.spark_partition_id())


def map_batches(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """User logic over the Arrow batches of a partition, for logic built-ins cannot express."""
    return df.mapInPandas(fn, schema)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def take_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows chosen by the digest of a key: a top-n, not a sort of the whole table."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(digest, F.col(key)).limit(n)


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def running_total(df: DataFrame, order: list[str], value: str, name: str = "upto") -> DataFrame:
    """Adds the total of ``value`` over the rows up to each row in the given (unique) order.

    As in :func:`row_index`, the rows are range partitioned and fixed; a window runs within one
    partition, and the totals of the partitions before it are added.
    """
    placed = durable(df.orderBy(*order).withColumn("_p", F.spark_partition_id()))
    sums = placed.groupBy("_p").agg(F.sum(value).alias("_t"))
    # one row per partition of the sorted data
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_p", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    within = F.sum(value).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_w", within).join(F.broadcast(offsets), "_p").withColumn(name, F.col("_o") + F.col("_w")).drop("_p", "_o", "_w")


def spread_out(df: DataFrame, piece_rows: int | None = None) -> DataFrame:
    """Spread a scan of few splits over all cores before heavy work per row.

    A large input has more splits than cores and is left as it is. With ``piece_rows`` it is dealt to
    pieces of about that many rows at most, where its splits hold more: for rows that are kept, which
    grow by their features. For plain scans only: the partitions of a shuffled frame are not known
    without running it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = cores * max(1, math.ceil(df.count() / (piece_rows * cores))) if piece_rows else cores
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def layout(
    df: DataFrame, partitions: int | None = None, key: str | None = None, shrink: bool = False, spread: int = 1
) -> DataFrame:
    """Repartition (optionally by key) or, with ``shrink``, merge partitions without a shuffle.

    With ``spread`` the rows of one key are placed in up to that many partitions.
    """
    if shrink:
        return df.coalesce(partitions)
    if key is None:
        return df.repartition(partitions)
    places = [F.col(key)]
    if spread > 1:
        places.append(F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    return df.repartition(partitions, *places) if partitions else df.repartition(*places)
