"""Equi joins, cogroup, lookups and positional zip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.partitions import row_index
from pulsegrid.session import durable


def join_by_key(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Equi join; adaptive execution picks broadcast by measured size and splits skewed partitions."""
    return left.join(right, on, how)


def outer_join(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """Left or right outer join that survives a hot key on the side that is not preserved.

    Adaptive execution cannot split that side of an outer join. Matches come from an inner join,
    where both sides can be split, and the rows without a match from an anti join on distinct keys.
    """
    kept, other = (left, right) if how == "left" else (right, left)
    matched = left.join(right, on)
    alone = anti_by_key(kept, other, on)
    return matched.unionByName(alone, allowMissingColumns=True)


def salted_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "inner", salts: int = 16, hot_share: float = 0.01
) -> DataFrame:
    """Join whose hot left keys are spread over ``salts`` tasks each.

    Use it when the result is grouped by the same key, where adaptive execution keeps the
    partitioning and cannot split; count equal left rows first where there are many. A key is hot
    when it holds more than ``hot_share`` of the left rows, so there are fewer than 1 / hot_share
    of them; only the right rows of hot keys are copied, once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join keeps right rows once per match only for inner and left joins")
    hot = left.groupBy(on).count().filter(F.col("count") > hot_share * left.count())
    hot = F.broadcast(durable(hot.select(on, F.lit(salts).alias("_copies"))))
    # a digest of the whole row, not a random number: a recomputed task must give the same salt
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    marked = left.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_copies").isNotNull(), spread).otherwise(F.lit(0))
    )
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    copied = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return marked.drop("_copies").join(copied.drop("_copies"), [on, "_salt"], how).drop("_salt")


def anti_by_key(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def cogroup_rows(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Values of both sides per key as rows ``key, side, value, copies``; the same shape for a key of any size."""
    sides = left.select(key, F.lit("left").alias("side"), F.col(value).alias("value")).unionByName(
        right.select(key, F.lit("right").alias("side"), F.col(value).alias("value"))
    )
    return sides.groupBy(key, "side", "value").agg(F.count("*").alias("copies"))


def value_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Values per key as rows ``key, value, copies``."""
    return df.groupBy(key, F.col(value).alias("value")).agg(F.count("*").alias("copies"))


def lookup_dim(facts: DataFrame, dim: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join a dimension; adaptive execution broadcasts it when its measured bytes are few."""
    return facts.join(dim, on, how)


def outer_with_default(left: DataFrame, right: DataFrame, on: str, defaults: dict[str, object]) -> DataFrame:
    joined = left.join(right, on, "left")
    for name, value in defaults.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def zip_by_position(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str]) -> DataFrame:
    """Pair row ``i`` of ``a`` with row ``i`` of ``b``, each taken in its own order; sizes must agree."""
    left, right = row_index(a, order_a, "pos"), row_index(b, order_b, "pos")
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"cannot zip {n_left} rows with {n_right} rows")
    return left.join(right, "pos")
