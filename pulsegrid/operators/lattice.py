"""Every subset of a list of conditions, answered from one pass.

A row's mask has bit ``i`` set when it meets condition ``i``; the row belongs to each subset whose
bits are all in its mask. Rows are summed per mask first, so that only the few masks are expanded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import byte_length
from pulsegrid.operators.filters import Conditions, _pairs, key_is

def condition_mask(conditions: Conditions) -> Column:
    pairs = _pairs(conditions)
    if len(pairs) > 62:
        raise ValueError("a mask has 62 bits")
    one, none = lambda i: F.lit(1 << i).cast("long"), F.lit(0).cast("long")
    bits = [F.when(key_is(key, value), one(i)).otherwise(none) for i, (key, value) in enumerate(pairs)]
    return reduce(lambda a, b: a + b, bits, none)


def subset_label(conditions: Conditions, subset: Column) -> Column:
    """Values of the subset's conditions joined by ``_``; the empty subset is ``all``."""
    parts = [
        F.when(F.shiftright(subset, i).bitwiseAND(1) != 0, F.lit(str(value))) for i, (_, value) in enumerate(_pairs(conditions))
    ]
    text = F.concat_ws("_", *parts)
    return F.when(subset == 0, F.lit("all")).otherwise(text)


#: Conditions whose subsets are formed before rows are added up again.
CHUNK = 5


def expand_subsets(df: DataFrame, bits: range, mask: str = "mask") -> DataFrame:
    """``subset``: the mask with any of its bits in a range cleared; a row for each, so only the bits that are set double the rows."""
    if not len(bits):
        return df.withColumn("subset", F.col(mask))
    rest = ~sum(1 << i for i in bits)
    subsets = F.expr(
        f"aggregate(sequence({bits[0]}, {bits[-1]}), array(`{mask}` & {rest}L), (found, i) -> "
        f"if(shiftright(`{mask}`, i) & 1L = 1L, concat(found, transform(found, s -> s | shiftleft(1L, i))), found))"
    )
    return df.withColumn("subset", F.explode(subsets))


def superset_sums(summed: DataFrame, conditions: Conditions, keys: list[str], measures: list[str]) -> DataFrame:
    """Sums per ``mask`` and keys become sums per ``subset`` and keys: of all masks that hold the subset.

    A few bits at a time are cleared and the rows added up, so that there are never more rows than
    subsets that occur times what a few bits multiply, however many conditions there are.
    """
    n = len(_pairs(conditions))
    out = summed
    for low in range(0, max(n, 1), CHUNK):
        spread = expand_subsets(out, range(low, min(low + CHUNK, n)))
        out = spread.groupBy(F.col("subset").alias("mask"), *keys).agg(*[F.sum(m).alias(m) for m in measures])
    return out.withColumnRenamed("mask", "subset")


def lattice_totals(df: DataFrame, conditions: Conditions, amount: str, payload: str = "payload") -> DataFrame:
    """Count, bytes and amount of every subset."""
    masked = df.groupBy(condition_mask(conditions).alias("mask")).agg(
        F.count("*").alias("n"), F.sum(byte_length(payload)).alias("bytes"), F.sum(amount).alias("amount")
    )
    found = superset_sums(masked, conditions, [], ["n", "bytes", "amount"])
    return found.withColumn("label", subset_label(conditions, F.col("subset")))


def lattice_rankings(df: DataFrame, conditions: Conditions, dims: list[str], amount: str) -> DataFrame:
    """Count and amount per value of each dimension in every subset."""
    masked = df.select(
        condition_mask(conditions).alias("mask"),
        F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])).alias("d"),
        F.col(amount).alias("amount"),
    )
    summed = masked.groupBy("mask", "d.dim", "d.value").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    found = superset_sums(summed, conditions, ["dim", "value"], ["n", "amount"])
    return found.withColumn("label", subset_label(conditions, F.col("subset")))


def top_of_lattice(rankings: DataFrame, measure: str, k: int) -> DataFrame:
    """First ``k`` values of each subset and dimension."""
    from pulsegrid.operators.ranking import top_per_group

    return top_per_group(rankings, ["subset", "dim"], [F.desc(measure), F.asc("value")], k)
