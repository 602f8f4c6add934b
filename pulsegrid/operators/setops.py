"""Set operations on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_bag(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def intersect_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both; each side is made distinct before the two meet."""
    return a.select(*b.columns).distinct().intersect(b.distinct())


def subtract_keep(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with no equal row in ``b``; duplicates among the survivors are kept."""
    right = b.distinct().toDF(*[f"_r_{c}" for c in b.columns])
    same = reduce(lambda x, y: x & y, (a[c].eqNullSafe(right[f"_r_{c}"]) for c in b.columns))
    return a.join(right, same, "left_anti")


def distinct_rows(a: DataFrame) -> DataFrame:
    return a.distinct()
