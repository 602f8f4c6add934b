"""Running totals: one stateful aggregation per question, keyed so that state spreads over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import byte_length
from pulsegrid.operators.filters import Conditions
from pulsegrid.operators.lattice import condition_mask, superset_sums

__all__ = [
    "dim_totals",
    "global_totals",
    "lattice_stream",
    "lattice_subsets",
    "merge_totals",
    "running_totals",
    "sum_and_count_by_value",
    "user_purchases",
    "with_initial",
]


def running_totals(stream: DataFrame, keys: list[str], amount: str | None = None, payload: str | None = None) -> DataFrame:
    """Running count, and optionally bytes and amount, per key."""
    measures = [F.count("*").alias("n")]
    if payload:
        measures.append(F.sum(byte_length(payload)).alias("bytes"))
    if amount:
        measures.append(F.sum(amount).alias("amount"))
    return stream.groupBy(*keys).agg(*measures)


def global_totals(stream: DataFrame, amount: str, payload: str) -> DataFrame:
    """Running count, bytes and amount of everything; map tasks reduce to one row each."""
    return running_totals(stream, [], amount, payload)


def with_initial(totals: DataFrame, initial: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Totals read from a table plus totals carried over from before the stream began."""
    both = totals.select(*keys, *measures).unionByName(initial.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def merge_totals(totals: list[DataFrame], keys: list[str], measures: list[str]) -> DataFrame:
    first, *rest = totals
    for other in rest:
        first = with_initial(first, other, keys, measures)
    return first


def dim_totals(stream: DataFrame, dims: list[str], amount: str) -> DataFrame:
    """Running count and amount per value of several dimensions: a row becomes one row per
    dimension, so a single state holds what would be two states per dimension."""
    cells = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    flat = stream.select(F.explode(cells).alias("d"), F.col(amount).alias("amount"))
    return flat.groupBy("d.dim", "d.value").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def lattice_stream(stream: DataFrame, conditions: Conditions, amount: str, payload: str, dims: list[str] | None = None) -> DataFrame:
    """Running totals per ``mask`` of the conditions that a row meets; with ``dims`` also per dimension value.

    State has a row for each mask that occurs (and value), whatever the number of conditions;
    :func:`lattice_subsets` makes the subsets of it where it is read.
    """
    masked = stream.withColumn("mask", condition_mask(conditions))
    if not dims:
        return masked.groupBy("mask").agg(
            F.count("*").alias("n"), F.sum(byte_length(payload)).alias("bytes"), F.sum(amount).alias("amount")
        )
    cells = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    flat = masked.select("mask", F.explode(cells).alias("d"), F.col(amount).alias("amount"))
    return flat.groupBy("mask", "d.dim", "d.value").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def lattice_subsets(totals: DataFrame, conditions: Conditions) -> DataFrame:
    """Totals of every subset of the conditions from the totals per mask."""
    measures = [c for c in ("n", "bytes", "amount") if c in totals.columns]
    keys = [c for c in ("dim", "value") if c in totals.columns]
    return superset_sums(totals, conditions, keys, measures)


def user_purchases(stream: DataFrame, user: str, price: str) -> DataFrame:
    """Purchases and revenue of each user so far."""
    return stream.groupBy(F.col(user).alias("user")).agg(F.count("*").alias("purchases"), F.sum(price).alias("revenue"))


def sum_and_count_by_value(stream: DataFrame, value: str | Column) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return stream.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
