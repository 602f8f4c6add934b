import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.operators import aggregates as agg
from pulsegrid.operators import filters, ranking

LINES = [
    '{"SID":"a","price":5,"city":"x"}',
    '{"SID":"a","price":5,"city":"x"}',
    '{"SID":"b","price":7,"city":"y"}',
    '{"SID":"c","price":9,"city":"é"}',
]


def messages(spark):
    from pulsegrid.sources import parse_messages

    return parse_messages(spark.createDataFrame([(x,) for x in LINES], "payload string"))


def test_bytes_are_utf8(spark):
    assert agg.message_bytes(messages(spark)).first().bytes == sum(len(x.encode()) for x in LINES)
    assert agg.message_bytes(messages(spark).filter("false")).first().bytes == 0


def test_numeric_field_matches_its_text(spark):
    assert agg.count_where(messages(spark), "price", "5").first().n == 2
    assert agg.count_where(messages(spark), "price", 5).first().n == 2


def test_missing_field_is_no_match(spark):
    assert agg.count_where(messages(spark), "ram", "2GB").first().n == 0


def test_and_bag_keeps_and_set_drops_duplicates(spark):
    rules = [("SID", "a"), ("price", 5)]
    assert filters.condition_filter(messages(spark), rules).count() == 2
    assert filters.and_filter_set(messages(spark), rules).count() == 1
    assert filters.condition_filter(messages(spark), []).count() == 4


def test_or_keeps_duplicates_once_per_row(spark):
    assert filters.or_filter(messages(spark), [("SID", "a"), ("price", 5), ("city", "y")]).count() == 3
    assert filters.or_filter(messages(spark), []).count() == 0


def test_condition_key_is_in_argument_order():
    assert filters.condition_key([("brand", "x"), ("city", "y")]) == "brand_city_"


def test_group_averages(spark):
    data = [("north", 11), ("south", 2), ("north", 8), ("south", 2), ("south", 5), ("west", 40), ("north", 1)]
    df = spark.createDataFrame(data, "k string, v long")
    found = rows(agg.avg_sum_by(df, "k", "v"))
    assert found == [("north", 20, 20 / 3, 6), ("south", 9, 3.0, 3), ("west", 40, 40.0, 40)]


def test_rank_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in ranking.rank_by_count(df, "k").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_rank_report_orders_both_ways(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("b", 2)], "k string, v long")
    assert rows(ranking.rank_report(df, "k", "v", [], 1)) == [("amount", "a", 10), ("count", "b", 2)]


def test_correlation_literal(spark):
    x, y = (1.5, 2.25, -4, 0, 9.75, 3), (12, 10.5, 30, 31, -6, 8)
    df = spark.createDataFrame(list(zip(map(float, x), map(float, y))), "x double, y double")
    assert abs(agg.pearson(df, "x", "y").first().correlation - np.corrcoef(x, y)[0, 1]) < 1e-12


def test_column_statistics_literal(spark):
    df = spark.createDataFrame([(7, 0), (1, -3), (4, 0), (0, 11)], "a long, b long")
    found = {r["column"]: r for r in agg.column_statistics(df, ["a", "b"]).collect()}
    assert abs(found["a"]["mean"] - 3.0) < 1e-9
    assert found["b"]["nonzeros"] == 2 and found["b"]["high"] == 11.0
    assert abs(found["a"]["variance"] - 10.0) < 1e-9


def test_hard_label_areas_agree_with_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    pairs = [(1.0, 1.0)] * 30 + [(1.0, 0.0)] * 10 + [(0.0, 1.0)] * 5 + [(0.0, 0.0)] * 55
    df = spark.createDataFrame(pairs, "label double, prediction double")
    row = agg.hard_label_metrics(df, "label", "prediction").first()
    for metric, value in (("areaUnderROC", row.roc_area), ("areaUnderPR", row.pr_area)):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="label", metricName=metric)
        assert abs(evaluator.evaluate(df) - value) < 1e-9
    assert row.accuracy == 0.85


def test_kpi_panel_held_or_not(spark):
    want = (4, 26, 5, 6.5, sum(len(x.encode()) for x in LINES))
    assert tuple(agg.kpi_panel(messages(spark), "price").first()) == want
    held = agg.kpi_panel(messages(spark), "price", hold=True)
    assert tuple(held.first()) == want and held.dtypes == agg.kpi_panel(messages(spark), "price").dtypes
    empty = agg.kpi_panel(messages(spark).filter("false"), "price", hold=True).first()
    assert (empty.n, empty.total, empty.median) == (0, None, None)


def test_purchase_report(spark):
    df = spark.createDataFrame([("u", "p", 3), ("u", "q", 4), ("v", "q", 5), ("w", "p", 1)], "u string, p string, v long")
    assert tuple(agg.purchase_report(df, "u", "p", "v").first()) == (4, 3, 13, "p", 2)


def test_point_lookup_outcomes(spark):
    readings = spark.createDataFrame([("t1", 5.0), ("t2", 7.0), ("t2", 6.0)], "t string, v double")
    requests = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "t string")
    assert rows(filters.point_lookup(requests, readings, "t", "v")) == [
        ("t1", 1, 5.0, "one"),
        ("t2", 2, 6.0, "duplicated"),
        ("t3", 0, 0.0, "missing"),
    ]


def test_listed_words(spark):
    words = spark.createDataFrame([("a",), ("b",), ("a",), ("z",)], "w string")
    listed = spark.createDataFrame([("a",), ("c",), ("a",)], "x string")
    assert rows(filters.listed_filter(words, "w", listed, "x")) == [("a",), ("a",)]
    assert rows(filters.listed_filter(words, "w", listed, "x", "unlisted")) == [("b",), ("z",)]
    report = rows(filters.listed_report(words, "w", listed, "x"))
    assert report == [("a", 2, True), ("b", 1, False), ("z", 1, False)]


def test_splits_cover_every_row_once(spark):
    df = spark.range(1000)
    parts = filters.hash_split(df, "id", [0.6, 0.3, 0.1], 5).groupBy("part").count()
    counts = dict(rows(parts))
    assert sum(counts.values()) == 1000 and set(counts) == {0, 1, 2}
    assert abs(counts[0] - 600) < 80
    folded = filters.k_folds(df, "id", 4, 100)
    sizes = [tuple(x.count() for x in filters.fold_pair(folded, i)) for i in range(4)]
    assert all(a + b == 1000 for a, b in sizes) and sum(b for _, b in sizes) == 1000


def test_split_is_the_same_for_any_partitioning(spark):
    a = filters.hash_split(spark.range(200), "id", [0.5, 0.5], 1)
    b = filters.hash_split(spark.range(200).repartition(7), "id", [0.5, 0.5], 1)
    assert rows(a) == rows(b)


def test_year_split(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2007-06-01', timestamp'2010-06-01', interval 1 year)) AS ts")
    train, test = filters.year_split(df, "ts", [2007, 2008], [2009, 2010])
    assert train.agg(F.max(F.year("ts"))).first()[0] == 2008 and test.count() == 2
