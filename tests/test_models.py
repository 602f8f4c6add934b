import os
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pulsegrid import sources
from pulsegrid.ml import cluster, features, models, online, recommend, reduce
from pulsegrid.plans import models as plans


def test_one_hot_keeps_unseen_values(spark):
    train = spark.createDataFrame([("b", "x", 1.0), ("a", "y", 2.0)], "p string, q string, n double")
    model = features.one_hot_pipeline(["p", "q"], ["n"]).fit(train)
    found = model.transform(train.union(spark.createDataFrame([("z", "x", 3.0)], train.schema)))
    arrays = [r[0] for r in found.select(vector_to_array("features")).collect()]
    # alphabetic slots a, b, other | x, y, other | n
    assert arrays == [[0, 1, 0, 1, 0, 0, 1.0], [1, 0, 0, 0, 1, 0, 2.0], [0, 0, 1, 1, 0, 0, 3.0]]


def labelled(spark, n=600):
    rng = random.Random(7)
    data = []
    for i in range(n):
        a, b = rng.random(), rng.random()
        data.append((i, float(a + b > 1), 3 * a - b + 2, a, b))
    return spark.createDataFrame(data, "id long, label double, target double, a double, b double")


def test_all_classifiers_learn(spark):
    rows_ = features.assembled(labelled(spark), ["a", "b"], "label")
    specs = {
        "logistic": {"maxIter": 20},
        "svm": {"maxIter": 20},
        "bayes": {},
        "tree": {"maxDepth": 5},
        "forest": {"maxDepth": 5, "numTrees": 5, "seed": 1},
    }
    report = {r.model: r for r in models.evaluate_all("classify", rows_, rows_, specs).collect()}
    assert set(report) == set(specs)
    assert all(report[m].roc_area > 0.9 for m in ("logistic", "svm", "tree", "forest"))


def test_depth_helps(spark):
    rows_ = features.assembled(labelled(spark), ["a", "b"], "label")
    found = {r.parameters: r.accuracy for r in models.sweep("classify", rows_, rows_, "tree", [{"maxDepth": 1}, {"maxDepth": 6}]).collect()}
    assert found["maxDepth=6"] > found["maxDepth=1"]


def test_regression_and_log_label(spark):
    rows_ = features.assembled(labelled(spark), ["a", "b"], "target")
    report = models.evaluate_all("regress", rows_, rows_, {"linear": {}, "tree": {"maxDepth": 3}})
    found = {r.model: r for r in report.collect()}
    assert found["linear"].mse < 1e-6 < found["tree"].mse
    logged = rows_.withColumn("label", F.log("label"))
    scored = models.estimator("regress", "tree", maxDepth=8).fit(logged).transform(logged)
    assert models.log_label_metrics(scored).first().mse < found["tree"].mse


def test_minute_model_predicts_the_mean(spark):
    data = [("2024-01-01 00:05:00", 2.0), ("2024-01-02 00:05:10", 4.0), ("2024-01-02 10:00:00", 9.0)]
    df = spark.createDataFrame(data, "t string, v double").withColumn("ts", F.to_timestamp("t"))
    asked = spark.createDataFrame([("2024-02-01 00:05:59", 6.0), ("2024-02-01 03:00:00", 1.0)], "t string, v double")
    found = models.minute_predictions(df, asked.withColumn("ts", F.to_timestamp("t")), "v")
    assert rows(found, "minute", "prediction") == [(180, 5.0), (5, 3.0)]
    assert models.with_error(found.withColumn("actual", F.col("v"))).filter("minute = 5").first().error_pct == 50.0


def ratings(spark):
    rng = random.Random(5)
    data = {(u, p): float(1 + (u * p + rng.randrange(3)) % 5) for u in range(40) for p in rng.sample(range(30), 12)}
    return spark.createDataFrame([(u, p, r) for (u, p), r in data.items()], "user int, product int, rating double")


@pytest.fixture(scope="module")
def als(spark):
    return recommend.train_als(ratings(spark), rank=6, iterations=5, reg=0.05)


def test_recommendations_for_all_and_for_given_users(spark, als):
    every = recommend.recommend_all(als, 5)
    assert every.count() == 40 * 5
    some = recommend.recommend(als, spark.createDataFrame([(3,), (3,), (4,)], "user int"), 5)
    both = every.join(some.withColumnRenamed("score", "other"), ["user", "rank"])
    assert some.count() == both.count() == 10 and both.filter("abs(score - other) > 1e-4").count() == 0


def test_factor_model_gets_more_blocks_with_the_ratings(spark, monkeypatch):
    made, plain = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **spec: made.append(spec) or plain(**spec))
    few = recommend.train_als(ratings(spark), rank=2, iterations=1)
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 40)
    many = recommend.train_als(ratings(spark), rank=2, iterations=1)
    assert [(s["numUserBlocks"], s["numItemBlocks"]) for s in made] == [(10, 10), (12, 12)]
    assert few.userFactors.count() == many.userFactors.count() == 40 and many.itemFactors.count() == few.itemFactors.count()


def test_rating_errors(spark, als):
    found = recommend.rating_errors(ratings(spark), recommend.predict_pairs(als, ratings(spark))).first()
    assert found.n == 480 and abs(found.rmse**2 - found.mse) < 1e-9 and found.rmse < 1.5


def test_average_precision_by_hand(spark):
    predicted = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (3, 10, 1), (1, 13, 4)], "user int, product int, rank int"
    )
    actual = spark.createDataFrame([(1, 10), (1, 10), (1, 12), (1, 99), (1, 13), (3, 11)], "user int, product int")
    found = {r.user: r.average_precision for r in recommend.average_precision(actual, predicted, 3).collect()}
    # user 1: hits at ranks 1 and 3 of the first three, four... three of min(4 owned, 3)
    assert abs(found[1] - (1 / 1 + 2 / 3) / 3) < 1e-12
    assert found[2] == 1.0 and found[3] == 0.0
    assert recommend.mean_average_precision(actual, predicted, 3).first().users == 3


def test_ranking_map_agrees_with_sparks_evaluator(spark, als):
    from pyspark.ml.evaluation import RankingEvaluator

    actual, predicted = ratings(spark), recommend.recommend_all(als, 8)
    owned = actual.groupBy("user").agg(F.collect_set(F.col("product").cast("double")).alias("label"))
    ranked = predicted.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("product").cast("double").alias("p")))).alias("r"))
    both = owned.join(ranked, "user").select("label", F.transform("r", lambda x: x["p"]).alias("prediction"))
    want = RankingEvaluator(metricName="meanAveragePrecision").evaluate(both)
    assert abs(recommend.ranking_map(actual, predicted).first().ranking_map - want) < 1e-12


def test_similar_items(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "id int, features array<double>")
    found = recommend.similar_items(items, 1, 3).collect()
    assert [r.id for r in found] == [1, 2, 3] and found[0].similarity == 1.0
    with pytest.raises(KeyError):
        recommend.similar_items(items, 77, 3)


def points(spark):
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=4) * 0.1 + (10 if i % 2 else 0)).tolist()) for i in range(60)]
    return spark.createDataFrame(data, "id long, embedding array<double>"), np.array([d[1] for d in data])


def test_kmeans(spark):
    df, matrix = points(spark)
    model = cluster.fit_kmeans(df, 2)
    placed = cluster.assign(df, model)
    assert abs(cluster.cluster_cost(placed).first().cost - model.summary.trainingCost) < 1e-6
    assert placed.groupBy("cluster").count().filter("count = 30").count() == 2
    near = cluster.nearest_members(placed, "id", 5)
    assert near.count() == 10 and near.agg(F.max("rank")).first()[0] == 5
    costs = {r.k: r.cost for r in cluster.cost_by_k(df, "id", [2, 4]).collect()}
    spread = float(((matrix - matrix.mean(axis=0)) ** 2).sum())
    assert set(costs) == {2, 4} and all(0 < c < spread / 100 for c in costs.values())


def test_components_match_numpy(spark):
    df, matrix = points(spark)
    centred = matrix - matrix.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    model, projected = reduce.pca_projection(df, 2)
    loadings = [r.loadings for r in reduce.component_rows(model, spark).orderBy("component").collect()]
    assert np.allclose(np.abs(loadings), np.abs(vt[:2]), atol=1e-6)
    values = [r.singular_value for r in reduce.singular_values(df, 2).orderBy("component").collect()]
    assert np.allclose(values, s[:2])
    # the projection is the centred rows times the right vectors, up to sign
    ours = np.abs(np.array([r.projection for r in projected.orderBy("id").collect()]))
    assert np.allclose(ours, np.abs(centred @ vt[:2].T), atol=1e-6)


def test_online_regression_matches_numpy(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 3))
    y = x @ np.array([1.0, -2.0, 0.5])
    (tmp_path / "in").mkdir()
    for b in range(3):
        lines = [f"{float(t)!r}\t" + ",".join(repr(float(v)) for v in row) for t, row in zip(y[b * 30 : b * 30 + 30], x[b * 30 : b * 30 + 30])]
        (tmp_path / "in" / f"{b}.txt").write_text("\n".join(lines) + "\n")
        # files are taken in the order of their times
        os.utime(tmp_path / "in" / f"{b}.txt", (1_700_000_000 + b, 1_700_000_000 + b))
    model = online.OnlineRegression(spark, str(tmp_path / "w"), 3, {"slow": 0.01, "fast": 0.5}, iterations=2)
    stream = sources.open_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
    model.start(online.labelled_lines(stream), str(tmp_path / "state")).awaitTermination()
    found = {(r.batch_id, r.model): r for r in model.history().collect()}
    assert len(found) == 6
    for name, step in (("slow", 0.01), ("fast", 0.5)):
        w = np.zeros(3)
        for b in range(3):
            bx, by = x[b * 30 : b * 30 + 30], y[b * 30 : b * 30 + 30]
            assert abs(found[(b, name)].mse - np.mean((bx @ w - by) ** 2)) < 1e-9
            for i in (1, 2):
                w = w - step / i**0.5 * (bx.T @ (bx @ w - by)) / 30
            assert np.allclose(found[(b, name)].weights, w)
    assert found[(2, "fast")].mse < found[(0, "fast")].mse
    # a repeated batch starts from the weights before it and replaces its own row
    again = spark.createDataFrame([(float(t), row.tolist()) for t, row in zip(y[60:], x[60:])], "label double, features array<double>")
    model.train_batch(again, 2)
    repeated = {(r.batch_id, r.model): r.weights for r in model.history().collect()}
    assert np.allclose(repeated[(2, "fast")], found[(2, "fast")].weights) and len(repeated) == 6
    predicted = model.predict(again, "fast").first()
    assert abs(predicted.prediction - float(np.dot(x[60], repeated[(2, "fast")]))) < 1e-9


def test_purchase_lines(spark):
    parsed = online.purchase_lines(spark.createDataFrame([("u,p,9.5",)], "payload string"))
    assert rows(parsed) == [("u", "p", 9.5)]


def test_kept_rows_are_dealt_to_pieces_of_bounded_size(spark, folder, monkeypatch):
    lines = spark.range(4000).select(
        F.col("id").alias("l_orderkey"), F.expr("date_add(DATE'1995-01-01', CAST(id % 2000 AS INT))").alias("l_shipdate"), F.lit(3.0).alias("l_quantity"),
        F.lit(1).alias("l_linenumber"), F.lit(0.1).alias("l_discount"), (F.col("id") * 20.0).alias("l_extendedprice"),
    )
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(plans, "_PIECE_ROWS", 100)
    for part in (plans._prepared(spark, folder)[1], *plans._held_out(spark, folder, "share"), *plans._held_out(spark, folder, "years")):
        sizes = [r["count"] for r in part.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) > 1000 and max(sizes) <= 110


def test_combinations_are_encoded_as_their_rows(spark):
    schema = "p string, q string, n double"
    train = spark.createDataFrame([("a", "x", 1.0), ("b", None, 0.0), ("b", "y", 2.0), ("b", "y", 2.0), (None, "x", 5.0)], schema)
    other = train.union(spark.createDataFrame([("c", "x", 3.0), ("a", "z", 0.0)], schema))
    whole = features.one_hot_pipeline(["p", "q"], ["n"]).fit(train).transform(other)
    encoder = features.fit_one_hot(train, ["p", "q"])
    coded = features.with_one_hot(other, encoder, other.select("p", "q").distinct(), ["p", "q"], ["n"])
    assert coded.columns == ["p", "q", "n", "features"]
    assert rows(coded) == rows(whole, *coded.columns)
    kinds = [{kind: [a["idx"] for a in found] for kind, found in df.schema["features"].metadata["ml_attr"]["attrs"].items()} for df in (coded, whole)]
    assert kinds[0] == kinds[1]


def test_models_are_judged_together_as_one_by_one(spark, monkeypatch):
    train = features.assembled(labelled(spark, 300), ["a", "b"], "label")
    test = features.assembled(labelled(spark, 200).filter("id % 2 = 0"), ["a", "b"], "label")
    kept, persist = [], type(train).persist
    monkeypatch.setattr(type(train), "persist", lambda df, *level: kept.append(df) or persist(df, *level))
    specs = {"shallow": {"model": "tree", "maxDepth": 1, "seed": 5}, "logistic": {"maxIter": 3}, "forest": {"numTrees": 3, "seed": 1}}
    report = models.evaluate_all("classify", train, test, specs).collect()
    assert kept == [train] and not train.is_cached
    assert [r.model for r in report] == list(specs)
    for r in report:
        spec = dict(specs[r.model])
        scored = models.estimator("classify", spec.pop("model", r.model), **spec).fit(train).transform(test)
        assert tuple(r)[1:] == tuple(models.metrics_of("classify", scored).first())
    nobody = models.evaluate_all("classify", train, test.limit(0), {"logistic": {}}).first()
    assert tuple(nobody) == ("logistic", 0.0, 0.0, 0.5)


def test_training_rows_are_kept_on_disk_only(spark, monkeypatch):
    train = features.assembled(labelled(spark, 100), ["a", "b"], "label")
    levels, fitted = [], models._fitted
    monkeypatch.setattr(models, "_fitted", lambda kind, rows_, specs: levels.append(rows_.storageLevel) or fitted(kind, rows_, specs))
    models.evaluate_all("classify", train, train, {"tree": {"maxDepth": 1, "seed": 1}})
    assert [(x.useDisk, x.useMemory) for x in levels] == [(True, False)]


def test_pieces_are_counted_from_the_rows_of_a_part(spark, folder, monkeypatch):
    lines = spark.range(4000).select(
        F.col("id").alias("l_orderkey"), F.expr("date_add(DATE'1995-01-01', CAST(id % 4000 AS INT))").alias("l_shipdate"), F.lit(3.0).alias("l_quantity"),
        F.lit(1).alias("l_linenumber"), F.lit(0.1).alias("l_discount"), (F.col("id") * 20.0).alias("l_extendedprice"),
    )
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(plans, "_PIECE_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    for part, n in zip(plans._held_out(spark, folder, "years"), (1461, 1096)):
        assert part.count() == n
        assert part.rdd.getNumPartitions() == cores * -(-n // (100 * cores))
