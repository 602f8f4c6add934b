"""Exact order statistics without a global sort.

The wanted rank is ``floor((n+1)*q)`` kept inside 1..n, and the answer is the value at that rank.
Each pass reads one column and brackets the rank more tightly; only the number of rows below and
inside the bracket travels, so no task ever holds the column.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions import rank_position
from pulsegrid.operators.partitions import running_total
from pulsegrid.session import written


def quantile_rank(n: int, q: float) -> int:
    return max(1, min(n, math.floor((n + 1) * q)))


def lower_middle_rank(n: int, q: float = 0.5) -> int:
    """Rank ``ceil(n/2)``; ``q`` is not used."""
    return max(1, (n + 1) // 2)


@dataclass
class _Bracket:
    rank: int
    lo: object
    hi: object
    below: int = 0
    inside: int = 0

    @property
    def found(self) -> bool:
        return self.below < self.rank <= self.below + self.inside


def rank_select(
    df: DataFrame,
    column: str,
    quantiles: list[float],
    accuracy: int = 1_000,
    finish_rows: int = 50_000,
    rank_rule: Callable[[int, float], int] = quantile_rank,
) -> list[object]:
    """Exact value at the rank of each quantile; ``None`` for an empty column. Nulls are not counted."""
    values = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    first = values.agg(
        F.count("*").alias("n"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.percentile_approx("v", _around(quantiles, accuracy), accuracy).alias("cuts"),
    ).first()
    if first.n == 0:
        return [None] * len(quantiles)

    brackets = [
        _Bracket(rank_rule(first.n, q), first.cuts[2 * i], first.cuts[2 * i + 1]) for i, q in enumerate(quantiles)
    ]
    _count(values, brackets)
    for b in brackets:
        # the sketch may miss by a little: the rank then lies in the part just outside the bracket
        if b.rank <= b.below:
            b.lo, b.hi = first.lo, b.lo
        elif not b.found:
            b.lo, b.hi = b.hi, first.hi
    if not all(b.found for b in brackets):
        _count(values, brackets)

    for b in brackets:
        while b.lo != b.hi and b.inside > finish_rows:
            before = (b.lo, b.hi)
            _narrow(values, b, accuracy)
            if (b.lo, b.hi) == before:
                break
    return _finish(values, brackets, finish_rows)


def _around(quantiles: list[float], accuracy: int):
    slack = 2.0 / accuracy
    points = [p for q in quantiles for p in (max(0.0, q - slack), min(1.0, q + slack))]
    return F.array(*[F.lit(float(p)) for p in points])


def _within(b: _Bracket):
    return F.col("v").between(F.lit(b.lo), F.lit(b.hi))


def _count(values: DataFrame, brackets: list[_Bracket]) -> None:
    counts = []
    for i, b in enumerate(brackets):
        counts += [F.count_if(F.col("v") < F.lit(b.lo)).alias(f"b{i}"), F.count_if(_within(b)).alias(f"i{i}")]
    row = values.agg(*counts).first()
    for i, b in enumerate(brackets):
        b.below, b.inside = row[f"b{i}"], row[f"i{i}"]


def _narrow(values: DataFrame, b: _Bracket, accuracy: int) -> None:
    """Shrink the bracket to the neighbourhood of the rank inside it."""
    share = (b.rank - b.below) / b.inside
    row = values.filter(_within(b)).agg(F.percentile_approx("v", _around([share], accuracy), accuracy).alias("c")).first()
    inner = _Bracket(b.rank, row.c[0], row.c[1])
    _count(values, [inner])
    if inner.found:
        b.lo, b.hi, b.below, b.inside = inner.lo, inner.hi, inner.below, inner.inside
    else:
        side = _Bracket(b.rank, b.lo, inner.lo) if b.rank <= inner.below else _Bracket(b.rank, inner.hi, b.hi)
        if (side.lo, side.hi) != (b.lo, b.hi):
            _count(values, [side])
            b.lo, b.hi, b.below, b.inside = side.lo, side.hi, side.below, side.inside


def _finish(values: DataFrame, brackets: list[_Bracket], finish_rows: int) -> list[object]:
    """Pick all ranks from the values counted inside their brackets, in one job."""
    found = {i: b.lo for i, b in enumerate(brackets) if b.lo == b.hi}
    rest = {i: b for i, b in enumerate(brackets) if i not in found}
    if rest:
        matched = F.array_compact(F.array(*[F.when(_within(b), F.lit(i)) for i, b in rest.items()]))
        counts = (
            values.filter(reduce(lambda x, y: x | y, map(_within, rest.values())))
            .select("v", F.explode(matched).alias("b"))
            .groupBy("b", "v")
            .agg(F.count("*").alias("n"))
        )
        before = dict.fromkeys(rest, 0)
        if all(b.inside <= finish_rows for b in rest.values()):
            # at most finish_rows rows of a bracket reach this window, whatever the size of the table
            counts = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("b").orderBy("v")))
        else:  # the sketch could not narrow a bracket down: one running total over all brackets, in range partitions
            counts = running_total(counts, ["b", "v"], "n")
            before = dict(zip(rest, accumulate([0, *[b.inside for b in rest.values()]])))
        needs = F.create_map(*[F.lit(x) for i, b in rest.items() for x in (i, before[i] + b.rank - b.below)])
        picked = counts.filter(F.col("upto") >= needs[F.col("b")])
        # one row per quantile comes back
        found.update({row.b: row.v for row in picked.groupBy("b").agg(F.min("v").alias("v")).collect()})
    return [found[i] for i in range(len(brackets))]


def quantile_table(df: DataFrame, column: str, named: dict[str, float], **options) -> DataFrame:
    """One row per named quantile: ``statistic``, ``value``."""
    found = rank_select(df, column, list(named.values()), **options)
    kind = df.schema[column].dataType.simpleString()
    return df.sparkSession.createDataFrame(list(zip(named, found)), f"statistic string, value {kind}")


def middle_value(df: DataFrame, column: str) -> object:
    """Value at rank ``ceil(n/2)``."""
    return rank_select(df, column, [0.5], rank_rule=lower_middle_rank)[0]


def approximate_quantile(column: str, q: float = 0.5, accuracy: int = 10_000):
    """Sketch-based aggregate for places where an exact rank is not needed."""
    return F.percentile_approx(column, q, accuracy)


def grouped_rank_select(
    df: DataFrame,
    groups: list[str],
    column: str,
    q: float,
    buckets: int = 4_096,
    finish_rows: int = 65_536,
    weight: str | None = None,
    name: str = "value",
) -> DataFrame:
    """Exact order statistic per group, for groups of any size.

    A histogram of ``buckets`` equal steps between the group's extremes locates the bucket that
    holds the rank, again within it until no group's bucket holds more than ``finish_rows`` rows; only
    the last bucket's values are counted one by one.
    All counts are reduced before they are shuffled, and a window sees at most ``buckets`` rows or
    one bucket's distinct values. The groups are stored, so that the values are not shuffled while the
    groups' bytes are few. ``weight`` counts a row several times.
    """
    if not groups:
        raise ValueError("name at least one group; rank_select and bucketed_median answer for a whole column")
    values = df.select(*groups, F.col(column).alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    values = values.filter(F.col("_v").isNotNull())
    extent = values.groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_w").alias("_n"))
    bounds = written(extent.withColumn("_need", rank_position(F.col("_n"), q)).drop("_n"), "bounds")
    placed = _attach(values, bounds, groups)

    by_bucket = Window.partitionBy(*groups).orderBy("_b")
    rows = None
    while True:
        histogram = (
            placed.withColumn("_b", _bucket(buckets))
            .groupBy(*groups, "_b")
            .agg(F.sum("_w").alias("_c"), F.max("_need").alias("_need"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        )
        bounds = (
            histogram.withColumn("_upto", F.sum("_c").over(by_bucket))
            .filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_c") < F.col("_need")))
            .select(*groups, "_lo", "_hi", "_c", (F.col("_need") - F.col("_upto") + F.col("_c")).alias("_need"))
        )
        located = written(bounds, "bounds")
        open_rows = F.when(F.col("_lo") < F.col("_hi"), F.col("_c"))
        most, total = located.agg(F.max(open_rows), F.sum("_c")).first()
        # bounds of the located bucket replace those of the group, so one join per level is enough
        placed = _attach(values, located.drop("_c"), groups).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        if most is None or most <= finish_rows or total == rows:
            break
        rows = total
    by_value = Window.partitionBy(*groups).orderBy("_v")
    return (
        placed.groupBy(*groups, "_v")
        .agg(F.sum("_w").alias("_c"), F.max("_need").alias("_need"))
        .withColumn("_upto", F.sum("_c").over(by_value))
        .filter(F.col("_upto") >= F.col("_need"))
        .groupBy(*groups)
        .agg(F.min("_v").alias(name))
    )


def _bucket(buckets: int):
    """Step of ``_v`` between ``_lo`` and ``_hi``; non-decreasing in ``_v``."""
    lo, hi, v = (F.col(c).cast("double") for c in ("_lo", "_hi", "_v"))
    step = F.floor((v - lo) / (hi - lo) * F.lit(float(buckets)))
    return F.when(hi > lo, F.least(step, F.lit(buckets - 1).cast("long"))).otherwise(F.lit(0).cast("long"))


def _attach(left: DataFrame, right: DataFrame, groups: list[str]) -> DataFrame:
    """Null-safe join on the groups; ``right`` has one row per group."""
    keys = {g: f"_g{i}" for i, g in enumerate(groups)}
    same = [F.col(g).eqNullSafe(F.col(k)) for g, k in keys.items()]
    right = right.withColumnsRenamed(keys)
    return left.join(right, same).drop(*keys.values())


#: Rows of counts that the driver reads at once to find a rank in them.
FOLD = 4096


def _holder(counts: DataFrame, rank: int) -> tuple[object, int] | None:
    """The value of ``(x, c)`` counts that holds a rank, and the rank among its copies.

    Counts are folded into at most ``FOLD`` steps between the extremes, of which the one that holds the
    rank is folded again, until few values are left.
    """
    while True:
        low, high, values = counts.agg(F.min("x"), F.max("x"), F.count("*")).first()
        if values == 0:
            return None
        if values <= FOLD:
            rows = sorted(counts.select("x", "c").collect())
        else:
            step = F.floor((F.col("x") - F.lit(low)).cast("double") / (float(high) - float(low)) * (FOLD - 1))
            rows = sorted(counts.groupBy(step.alias("x")).agg(F.sum("c").alias("c")).collect())
        upto = 0
        for x, c in rows:
            if rank <= upto + c:
                break
            upto += c
        else:
            return None
        rank -= upto
        if values <= FOLD:
            return x, rank
        counts = counts.filter(step == x)


def bucketed_median(df: DataFrame, column: str, width: float, q: float = 0.5) -> DataFrame:
    """Global order statistic through a histogram of fixed bucket width, then the values of the one bucket that holds the rank."""
    values = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    bucket = F.floor(F.col("v") / F.lit(width))
    histogram = written(values.groupBy(bucket.alias("x")).agg(F.count("*").alias("c")), "histogram")
    n = histogram.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    found = _holder(histogram, quantile_rank(n, q)) if n else None
    if found is None:
        return values.agg(F.min("v").alias("value"))
    inside = written(values.filter(bucket == found[0]).groupBy(F.col("v").alias("x")).agg(F.count("*").alias("c")), "bucket")
    held = _holder(inside, found[1])
    return inside.filter(F.col("x") == F.lit(held[0])).select(F.col("x").alias("value"))
