import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.operators.filters import condition_filter
from pulsegrid.operators.lattice import lattice_rankings, lattice_totals, top_of_lattice
from pulsegrid.operators.time_buckets import distribution_report, time_distribution


def times(spark, *values):
    return spark.createDataFrame([(v, 10) for v in values], "t long, v long")


def amounts(df):
    return [r.amount for r in df.orderBy("pos").collect()]


def test_width_is_whole_and_the_rest_is_dropped(spark):
    df = times(spark, 0, 7, 8, 95, 96, 99, 100, -1)
    found = time_distribution(df, "t", 0, 100, 12)
    # width 8: 96..99 lie behind the last bucket
    assert amounts(found) == [2, 1] + [0] * 9 + [1]
    assert found.agg(F.max("bucket_end")).first()[0] == 96


def test_end_anchor_drops_the_rest_at_the_start(spark):
    df = times(spark, 0, 3, 4, 99, 100)
    assert amounts(time_distribution(df, "t", 0, 100, 12, anchor="end")) == [1] + [0] * 10 + [1]


def test_sum_and_empty(spark):
    assert amounts(time_distribution(times(spark, 1, 2, 60), "t", 0, 100, 2, "v")) == [20, 10]
    assert amounts(time_distribution(times(spark), "t", 0, 100, 3)) == [0, 0, 0]
    with pytest.raises(ValueError):
        time_distribution(times(spark, 1), "t", 0, 2, 3)


def test_timestamps_and_millis_agree_and_reach_the_scan(spark, folder):
    rng = random.Random(3)
    df = times(spark, *[rng.randrange(0, 10**9) for _ in range(500)]).withColumn("ts", F.timestamp_millis("t"))
    df.withColumn("ntz", F.col("ts").cast("timestamp_ntz")).write.parquet(folder + "/t")
    stored = spark.read.parquet(folder + "/t")
    results = [amounts(time_distribution(stored, c, 1000, 900_000_000, 7)) for c in ("t", "ts", "ntz")]
    assert results[0] == results[1] == results[2] and sum(results[0]) > 0
    for column in ("t", "ts", "ntz"):
        plan = time_distribution(stored, column, 1000, 900_000_000, 7)._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.split("\n") if "PushedFilters" in line][0]
        assert f"GreaterThanOrEqual({column}" in pushed and f"LessThan({column}" in pushed


def test_report_totals_include_the_rest(spark):
    df = times(spark, 1, 2, 99).withColumn("payload", F.lit("abc")).withColumn("brand", F.lit("x"))
    found = {(r.result_key, r.field): r.value for r in distribution_report(df, "t", {"brand": "x"}, 0, 100, 12).collect()}
    assert found[("brand__bytesNum", "value")] == "9" and found[("brand__count", "value")] == "3"
    assert found[("brand__distribution_count", "8")] == "2" and found[("brand__distribution_count", "96")] == "0"
    empty = distribution_report(df, "t", {"brand": "y"}, 0, 100, 12)
    assert empty.count() == 14 and {r.value for r in empty.collect()} == {"0"}


def test_lattice_equals_direct_filters(spark):
    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.choice("xy"), rng.choice("12"), rng.randrange(50), "p" * rng.randrange(5)) for _ in range(400)]
    df = spark.createDataFrame(data, "brand string, city string, ram string, price long, payload string")
    rules = [("brand", "a"), ("city", "y"), ("ram", "2")]
    totals = {r.subset: r for r in lattice_totals(df, rules, "price").collect()}
    ranks = lattice_rankings(df, rules, ["city", "ram"], "price")
    for subset in range(8):
        chosen = [rule for i, rule in enumerate(rules) if subset >> i & 1]
        direct = condition_filter(df, chosen)
        want = direct.agg(F.count("*"), F.sum(F.length("payload")), F.sum("price")).first()
        got = totals[subset]
        assert (got.n, got.bytes, got.amount) == tuple(want)
        assert got.label == ("_".join(v for _, v in chosen) or "all")
        by_city = direct.groupBy("city").agg(F.count("*"), F.sum("price"))
        assert rows(ranks.filter(f"subset = {subset} and dim = 'city'"), "value", "n", "amount") == rows(by_city)
    assert top_of_lattice(ranks, "n", 1).count() == len(list(itertools.product(range(8), ["city", "ram"])))


def test_lattice_of_twenty_conditions(spark):
    """Only the subsets of the masks in the data are expanded."""
    columns = [f"c{i}" for i in range(20)]
    data = [tuple(int(i in hit) for i in range(20)) + (n, "pp") for n, hit in enumerate([{0, 19}, {0, 7, 12}, set()])]
    df = spark.createDataFrame(data, ", ".join(f"{c} int" for c in columns) + ", price long, payload string")
    found = {r.subset: (r.n, r.bytes, r.amount, r.label) for r in lattice_totals(df, [(c, 1) for c in columns], "price").collect()}
    assert len(found) == 1 + 2 + 1 + 2 + 4  # the empty set and {0} are shared
    assert found[0] == (3, 6, 3, "all") and found[1] == (2, 4, 1, "1") and found[1 << 19 | 1] == (1, 2, 0, "1_1")
