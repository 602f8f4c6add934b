import math
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.rank_select import (
    bucketed_median,
    grouped_rank_select,
    lower_middle_rank,
    middle_value,
    quantile_rank,
    quantile_table,
    rank_select,
)

LIST = [-7, -7, 0, 3, 14, 15, 92, 65, 35, 89, 79, 32, 38, 46, 26, 43]


def expected(values, q):
    ordered = sorted(values)
    return ordered[max(1, min(len(ordered), math.floor((len(ordered) + 1) * q))) - 1]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def test_known_list(spark):
    assert middle_value(frame(spark, LIST), "v") == 32
    assert rank_select(frame(spark, LIST), "v", [0.5])[0] == 32
    assert bucketed_median(frame(spark, LIST), "v", 5).first().value == 32


def test_rank_is_floor_not_ceil(spark):
    assert rank_select(frame(spark, [10, 20, 30, 40, 50]), "v", [0.25]) == [10]
    assert [quantile_rank(5, q) for q in (0, 0.25, 0.5, 1)] == [1, 1, 3, 5]
    assert [lower_middle_rank(n) for n in (1, 2, 3, 20)] == [1, 1, 2, 10]


def test_empty_and_single(spark):
    assert rank_select(frame(spark, []), "v", [0.5, 0.9]) == [None, None]
    assert rank_select(frame(spark, [7]), "v", [0.0, 0.5, 1.0]) == [7, 7, 7]


@pytest.mark.parametrize("shape", ["uniform", "one hot value", "two ends", "long tail"])
def test_agrees_with_full_sort(spark, shape):
    rng = random.Random(shape)
    values = {
        "uniform": [rng.randrange(10**9) for _ in range(5000)],
        "one hot value": [5] * 3000 + [rng.randrange(100) for _ in range(2000)],
        "two ends": [rng.choice([0, 10**12]) for _ in range(3000)],
        "long tail": [int(math.exp(rng.uniform(0, 40))) for _ in range(5000)],
    }[shape]
    qs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 0.98, 1.0]
    want = [expected(values, q) for q in qs]
    df = frame(spark, values).repartition(5)
    # a coarse sketch and a small last step force every kind of narrowing
    assert rank_select(df, "v", qs, accuracy=20, finish_rows=10) == want
    assert rank_select(df, "v", qs) == want


def test_grouped_matches_full_sort(spark):
    rng = random.Random(1)
    data = [("hot", rng.randrange(10**6)) for _ in range(3000)] + [(f"g{i % 7}", rng.randrange(50)) for i in range(300)]
    data += [("one", 4), (None, 8), (None, 9), ("flat", 3), ("flat", 3)]
    df = spark.createDataFrame(data, "k string, v long")
    for finish in (5, 65_536):
        found = {r.k: r.value for r in grouped_rank_select(df, ["k"], "v", 0.5, buckets=16, finish_rows=finish).collect()}
        assert found == {k: expected([v for kk, v in data if kk == k], 0.5) for k in {k for k, _ in data}}


def test_grouped_weights_count_rows_several_times(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 1), ("a", 9, 1)], "k string, v long, w long")
    assert grouped_rank_select(df, ["k"], "v", 0.5, weight="w").first().value == 1


def test_grouped_needs_a_group(spark):
    with pytest.raises(ValueError):
        grouped_rank_select(frame(spark, [1]), [], "v", 0.5)


def test_quantile_table_keeps_the_type(spark):
    found = quantile_table(frame(spark, LIST).withColumn("v", F.col("v") / 2), "v", {"median": 0.5})
    assert found.dtypes[1] == ("value", "double") and found.first().value == 16.0


def test_grouped_without_broadcast_gives_the_same(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 10007).alias("v"))
    small = grouped_rank_select(df, ["k"], "v", 0.9, buckets=32)
    plain = grouped_rank_select(df, ["k"], "v", 0.9, buckets=32)
    assert sorted(small.collect()) == sorted(plain.collect())


def test_two_heavy_ends_with_a_thin_middle(spark):
    """A sketch that cannot narrow the bracket still gives the exact rank."""
    values = [0] * 400 + list(range(1, 200)) + [10_000] * 401
    found = rank_select(frame(spark, values), "v", [0.45, 0.5, 0.55], finish_rows=20)
    assert found == [expected(values, q) for q in (0.45, 0.5, 0.55)]


def test_long_tail_is_narrowed_level_by_level(spark):
    values = [v for v in range(3_000)] + [10**12, 10**15]
    df = frame(spark, values).withColumn("k", F.lit("a"))
    found = grouped_rank_select(df, ["k"], "v", 0.5, buckets=64, finish_rows=50).first().value
    assert found == expected(values, 0.5)
