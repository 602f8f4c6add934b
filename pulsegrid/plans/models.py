"""Model queries: features, evaluation, recommendation, clusters, components, online regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import threshold_label
from pulsegrid.ml import cluster, features, models, online, recommend, reduce
from pulsegrid.operators import aggregates as agg
from pulsegrid.operators import filters
from pulsegrid.operators.partitions import spread_out
from pulsegrid.operators.ranking import top_per_group
from pulsegrid.plans.registry import query
from pulsegrid.plans.streams import table_stream
from pulsegrid.plans.tables import RATINGS, part_titles, rating_triples, table
from pulsegrid.session import durable, work_path, written

# ---- meter models: calendar parts and order figures against the price of a line


def _readings(spark, sf):
    """Labelled rows: calendar parts as categories, three numeric measures, price as the measure to predict."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_discount") * 100).alias("discount"),
        (F.col("l_extendedprice") / 1000).alias("active_kw"),
    )
    parts = features.with_time_parts(rows).withColumn("label", threshold_label("active_kw", 40.0))
    return parts.drop("hour", "minute")


_CATEGORIES, _NUMBERS = ["year", "month", "day"], ["quantity", "line", "discount"]
#: A kept row takes up to some 300 bytes, also on its way to another executor.
_PIECE_ROWS = 1 << 17


def _encoded(rows, encoder, label):
    """Rows in pieces of bounded size, each with its vector; the days are found on the scan, before the rows are dealt."""
    dealt = spread_out(rows, _PIECE_ROWS).withColumn("label", F.col(label))
    days = rows.select(*_CATEGORIES).distinct()
    return features.with_one_hot(dealt, encoder, days, _CATEGORIES, _NUMBERS).select("id", "ts", "label", "features")


def _prepared(spark, sf, label="label"):
    rows = _readings(spark, sf)
    model = features.fit_one_hot(rows, _CATEGORIES)
    return model, _encoded(rows, model, label)


def _held_out(spark, sf, how, label="label"):
    """Training and test rows, by years or by a 60/40 share of the keys; the encoder knows the training rows only."""
    rows = _readings(spark, sf)
    if how == "years":
        parts = filters.year_split(rows, "ts", [1995, 1996, 1997, 1998], [1999, 2000, 2001])
    else:
        split = filters.hash_split(rows, "id", [0.6, 0.4], 123)
        parts = split.filter("part = 0"), split.filter("part = 1")
    encoder = features.fit_one_hot(parts[0], _CATEGORIES)
    return [_encoded(part, encoder, label) for part in parts]


_ROWS = """rd AS (SELECT l_shipdate AS ts, l_quantity AS quantity, CAST(l_linenumber AS DOUBLE) AS line, l_discount * 100 AS discount,
    l_extendedprice / 1000 AS active_kw, CASE WHEN l_extendedprice / 1000 >= 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM lineitem)"""


@query(
    "one_hot_features",
    f"""WITH {_ROWS}, w AS (SELECT count(DISTINCT year(ts)) + count(DISTINCT month(ts)) + count(DISTINCT day(ts)) + 3 + 3 AS width FROM rd)
        SELECT label, CAST((SELECT width FROM w) AS INTEGER) AS width, count(*) AS n FROM rd GROUP BY 1""",
)
def one_hot_features(spark, sf):
    """Width and number of non-zero slots of the encoded rows."""
    from pyspark.ml.functions import vector_to_array

    _, rows = _prepared(spark, sf)
    hot = rows.select(vector_to_array("features").alias("x"), "label")
    return hot.groupBy("label", F.size("x").alias("width")).agg(F.count("*").alias("n"))


def _scaled_sql(column):
    return f"""SELECT '{column}' AS "column", 0.0::DOUBLE AS mean, 1.0::DOUBLE AS variance,
      round((min({column}) - avg({column})) / stddev_samp({column}), 6) AS low,
      round((max({column}) - avg({column})) / stddev_samp({column}), 6) AS high FROM rd"""


@query("standardised_columns", f"WITH {_ROWS} " + " UNION ALL ".join(_scaled_sql(c) for c in ("quantity", "line", "discount")))
def standardised_columns(spark, sf):
    """Columns after scaling to mean 0 and deviation 1."""
    from pyspark.ml.functions import vector_to_array

    rows = features.assembled(_readings(spark, sf), _NUMBERS, "label")
    scaled = features.standardiser("features", "scaled").fit(rows).transform(rows)
    split = scaled.select(vector_to_array("scaled").alias("x")).select(*[F.col("x")[i].alias(c) for i, c in enumerate(_NUMBERS)])
    stats = agg.column_statistics(split, _NUMBERS)
    return stats.select("column", *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean", "variance", "low", "high")])


@query(
    "linear_fit",
    f"""WITH {_ROWS} SELECT round(regr_slope(active_kw, quantity), 6) AS slope, round(regr_intercept(active_kw, quantity), 6) AS intercept FROM rd""",
)
def linear_fit(spark, sf):
    """One-feature linear regression, whose solution has a closed form."""
    rows = features.assembled(_readings(spark, sf), ["quantity"], "active_kw")
    fitted = models.estimator("regress", "linear", solver="normal").fit(rows)
    found = [(float(fitted.coefficients[0]), float(fitted.intercept))]
    df = spark.createDataFrame(found, "slope double, intercept double")
    return df.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(
    "bayes_parameters",
    f"""WITH {_ROWS}, s AS (SELECT label, count(*) AS n, sum(quantity) AS q, sum(line) AS l, sum(floor(discount + 0.5)) AS d FROM rd GROUP BY 1)
        SELECT label, round(ln(n + 1.0) - ln((SELECT count(*) FROM rd) + 2.0), 9) AS prior, round(ln(q + 1) - ln(q + l + d + 3), 9) AS quantity,
               round(ln(l + 1) - ln(q + l + d + 3), 9) AS line, round(ln(d + 1) - ln(q + l + d + 3), 9) AS discount FROM s""",
)
def bayes_parameters(spark, sf):
    """Smoothed log probabilities of a naive Bayes model of three whole-number columns."""
    whole = _readings(spark, sf).withColumn("discount", F.floor(F.col("discount") + 0.5).cast("double"))
    fitted = models.estimator("classify", "bayes", smoothing=1.0).fit(features.assembled(whole, _NUMBERS, "label"))
    found = [
        (float(c), *[round(float(x), 9) for x in (fitted.pi[c], *fitted.theta.toArray()[c])]) for c in range(fitted.numClasses)
    ]
    return spark.createDataFrame(found, "label double, prior double, quantity double, line double, discount double")


@query(
    "score_roc_area",
    """WITH g AS (SELECT l_discount AS s, CAST(count(*) FILTER (WHERE l_tax >= 0.04) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE l_tax < 0.04) AS DOUBLE) AS n FROM lineitem GROUP BY 1),
       c AS (SELECT p, n, sum(p) OVER (ORDER BY s DESC) - p AS above FROM g)
       SELECT round(sum(n * (above + p / 2)) / (sum(p) * sum(n)), 9) AS roc_area FROM c""",
)
def score_roc_area(spark, sf):
    """Area under the ROC curve of a score with ties."""
    scored = table(spark, sf, "lineitem").select(threshold_label("l_tax", 0.04).alias("label"), F.col("l_discount").alias("score"))
    area = models.score_areas(scored, "score")["roc_area"]
    return spark.createDataFrame([(round(area, 9),)], "roc_area double")


_CLASSIFIERS = {
    "logistic": {"maxIter": 5},
    "svm": {"maxIter": 5},
    "bayes": {"smoothing": 1.0},
    "tree": {"maxDepth": 5, "impurity": "gini"},
    "forest": {"maxDepth": 4, "numTrees": 3, "seed": 1},
}


@query("classifier_report")
def classifier_report(spark, sf):
    """All classifiers trained and tested on the same rows."""
    _, rows = _prepared(spark, sf)
    return models.evaluate_all("classify", rows, rows, _CLASSIFIERS)


@query("classifier_holdout")
def classifier_holdout(spark, sf):
    """Trained on four years, tested on three others."""
    train, test = _held_out(spark, sf, "years")
    return models.evaluate_all("classify", train, test, _CLASSIFIERS)


_MINUTES = """e AS (SELECT event_id, event_type, value, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute,
    ('0x' || substr(md5('123:' || event_id), 1, 8))::BIGINT % 10000 < 6000 AS train FROM events),
  p AS (SELECT minute, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS DOUBLE) / count(*) AS prediction FROM e WHERE train GROUP BY 1),
  a AS (SELECT CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS DOUBLE) / count(*) AS overall FROM e WHERE train),
  s AS (SELECT floor(value * 100 + 0.5) AS label, coalesce(prediction, overall) AS prediction FROM e LEFT JOIN p USING (minute), a WHERE NOT train)"""


@query("classifier_holdout_share")
def classifier_holdout_share(spark, sf):
    """All classifiers, trained on 60 % of the rows and tested on the others."""
    train, test = _held_out(spark, sf, "share")
    return models.evaluate_all("classify", train, test, _CLASSIFIERS)


_REGRESSORS = {"linear": {"maxIter": 10}, "tree": {"maxDepth": 6, "maxBins": 64}}


@query("regression_holdout")
def regression_holdout(spark, sf):
    """Regressors trained on four years and tested on three others."""
    train, test = _held_out(spark, sf, "years", "active_kw")
    return models.evaluate_all("regress", train, test, _REGRESSORS)


@query("regression_holdout_share")
def regression_holdout_share(spark, sf):
    """Regressors trained on 60 % of the rows and tested on the others."""
    train, test = _held_out(spark, sf, "share", "active_kw")
    return models.evaluate_all("regress", train, test, _REGRESSORS)


def _sweep(spark, sf, model, grid):
    train, test = _held_out(spark, sf, "share")
    return models.sweep("classify", train, test, model, grid)


@query("iteration_sweep")
def iteration_sweep(spark, sf):
    """Iterations and regularisation of the logistic model."""
    return _sweep(spark, sf, "logistic", [{"maxIter": i, "regParam": r} for i in (1, 5, 10) for r in (0.0, 0.1)])


@query("forest_sweep")
def forest_sweep(spark, sf):
    """Number of trees of the forest."""
    return _sweep(spark, sf, "forest", [{"numTrees": n, "maxDepth": 4, "seed": 1} for n in (1, 3, 9)])


@query("model_report_job")
def model_report_job(spark, sf):
    """Figures of every classifier on the later years, published and kept once."""
    from pulsegrid import jobs
    from pulsegrid.sinks import MetricTable

    train, test = _held_out(spark, sf, "years")
    metrics = models.evaluate_all("classify", train, test, _CLASSIFIERS)
    return jobs.model_report(metrics, MetricTable(spark, work_path(spark, "model_report")), 0, "classify_by_years")


@query(
    "minute_profile_job",
    f"""WITH {_MINUTES}
        SELECT 'minute_profile' AS result_key, 'profile_' || name AS field, CAST(CAST(round(v, 3) AS DECIMAL(38, 6)) AS VARCHAR) AS value FROM (
          SELECT 'rows' AS name, count(*)::DOUBLE AS v FROM s UNION ALL SELECT 'mse', avg((prediction - label) * (prediction - label)) FROM s
          UNION ALL SELECT 'mae', avg(abs(prediction - label)) FROM s) t""",
)
def minute_profile_job(spark, sf):
    """The minute profile's held-out rows as a published and kept report."""
    from pulsegrid import jobs
    from pulsegrid.sinks import MetricTable

    error = F.col("prediction") - F.col("label")
    judged = _minute_scored(spark, sf).agg(
        F.lit("profile").alias("model"), F.count("*").cast("double").alias("rows"),
        F.round(F.avg(error * error), 3).alias("mse"), F.round(F.avg(F.abs(error)), 3).alias("mae"),
    )
    return jobs.model_report(judged, MetricTable(spark, work_path(spark, "minute_report")), 0, "minute_profile")


@query("classifier_sweep")
def classifier_sweep(spark, sf):
    """Depth and impurity sweep on a reproducible 60/40 split."""
    train, test = _held_out(spark, sf, "share")
    grid = [{"maxDepth": d, "impurity": i} for d in (1, 3, 5) for i in ("gini", "entropy")]
    return models.sweep("classify", train, test, "tree", grid)


@query("bayes_sweep")
def bayes_sweep(spark, sf):
    train, test = _held_out(spark, sf, "share")
    grid = [{"smoothing": s} for s in (0.001, 0.1, 10.0)]
    return models.sweep("classify", train, test, "bayes", grid)


@query("score_areas")
def score_areas(spark, sf):
    """Areas from raw scores of the linear machine and the logistic model."""
    _, rows = _prepared(spark, sf)
    rows.persist()
    found = []
    for name in ("svm", "logistic"):
        scored = models.estimator("classify", name, maxIter=5).fit(rows).transform(rows)
        areas = models.score_areas(scored)
        found.append((name, areas["roc_area"], areas["pr_area"]))
    rows.unpersist()
    return spark.createDataFrame(found, "model string, roc_area double, pr_area double")


@query("regression_report")
def regression_report(spark, sf):
    _, rows = _prepared(spark, sf, "active_kw")
    return models.evaluate_all("regress", rows, rows, {"linear": {"maxIter": 5}, "tree": {"maxDepth": 6, "maxBins": 64}})


@query("regression_sweep")
def regression_sweep(spark, sf):
    train, test = _held_out(spark, sf, "share", "active_kw")
    grid = [{"maxDepth": d, "maxBins": b} for d in (2, 5) for b in (10, 50)]
    return models.sweep("regress", train, test, "tree", grid)


@query("log_label_regression")
def log_label_regression(spark, sf):
    """A model of log(price), judged on the price scale."""
    _, rows = _prepared(spark, sf, "active_kw")
    logged = rows.withColumn("label", F.log("label"))
    scored = models.estimator("regress", "linear", maxIter=5).fit(logged).transform(logged)
    return models.log_label_metrics(scored)


def _minute_scored(spark, sf):
    from pulsegrid.plans.tables import event_readings

    split = filters.hash_split(event_readings(spark, sf), "event_id", [0.6, 0.4], 123)
    return models.minute_predictions(split.filter("part = 0"), split.filter("part = 1"), "active_kw")


@query(
    "minute_profile_model",
    f"""WITH {_MINUTES} SELECT round(avg((prediction - label) * (prediction - label)), 4) AS mse, round(avg(abs(prediction - label)), 6) AS mae,
        round(sqrt(avg(pow(ln(prediction + 1) - ln(label + 1), 2))), 6) AS rmsle FROM s""",
)
def minute_profile_model(spark, sf):
    """Prediction by the mean of the same minute of the day, judged on held-out rows."""
    found = agg.regression_metrics(_minute_scored(spark, sf), "label", "prediction")
    return found.select(F.round("mse", 4).alias("mse"), F.round("mae", 6).alias("mae"), F.round("rmsle", 6).alias("rmsle"))


@query("predict_at_times")
def predict_at_times(spark, sf):
    """Order dates as requested times: the actual reading, a model's answer and its error."""
    rows = spread_out(_readings(spark, sf), _PIECE_ROWS)
    encoder = features.one_hot_pipeline(_CATEGORIES, []).fit(rows)
    fitted = models.estimator("regress", "tree", maxDepth=5).fit(
        encoder.transform(rows.withColumn("label", F.col("active_kw")))
    )
    requests = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    known = filters.point_lookup(requests, rows, "ts", "active_kw")
    answers = models.predict_at(encoder, fitted, features.with_time_parts(known))
    return answers.select("o_orderkey", "outcome", "actual", "prediction", "error_pct")


# ---- recommendation


@query("als_recommendations")
def als_recommendations(spark, sf):
    """Ten products for every customer, with titles."""
    model = recommend.train_als(written(rating_triples(spark, sf), "ratings"), rank=10, iterations=3, reg=0.1)
    found = recommend.recommend_all(model, 10).join(part_titles(spark, sf), "product")
    return found.select("user", "rank", "product", "title")


@query("als_rating_errors")
def als_rating_errors(spark, sf):
    ratings = durable(rating_triples(spark, sf))
    model = recommend.train_als(ratings, rank=10, iterations=3, reg=0.1)
    return recommend.rating_errors(ratings, recommend.predict_pairs(model, ratings))


@query("als_mean_average_precision")
def als_mean_average_precision(spark, sf):
    """MAP at 10 over all customers."""
    ratings = durable(rating_triples(spark, sf))
    model = recommend.train_als(ratings, rank=10, iterations=3, reg=0.1)
    predicted = durable(recommend.recommend_all(model, 10))
    return recommend.mean_average_precision(ratings, predicted, 10)


@query(
    "rating_errors",
    f"""WITH {RATINGS}, p AS (SELECT product, sum(rating) / count(*) AS prediction FROM rt GROUP BY 1)
        SELECT round(avg((rating - prediction) * (rating - prediction)), 6) AS mse, round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
               count(*) AS n FROM rt JOIN p USING (product)""",
)
def rating_errors(spark, sf):
    """Errors of predicting each rating by the mean of its product."""
    ratings = rating_triples(spark, sf)
    means = ratings.groupBy("product").agg((F.sum("rating") / F.count("*")).alias("prediction"))
    predicted = ratings.join(means, "product").select("user", "product", "prediction")
    found = recommend.rating_errors(ratings, predicted)
    return found.select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"), "n")


@query(
    "average_precision",
    """WITH l AS (SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS product, o_orderstatus = 'F' AS past, l_quantity
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       a AS (SELECT DISTINCT "user", product FROM l WHERE NOT past),
       p AS (SELECT * FROM (SELECT "user", product, row_number() OVER (PARTITION BY "user" ORDER BY q DESC, product) AS rank
             FROM (SELECT "user", product, sum(l_quantity) AS q FROM l WHERE past GROUP BY 1, 2)) WHERE rank <= 10),
       h AS (SELECT p."user", rank, a.product IS NOT NULL AS hit FROM p LEFT JOIN a ON a."user" = p."user" AND a.product = p.product),
       c AS (SELECT *, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY "user" ORDER BY rank) AS upto FROM h),
       s AS (SELECT "user", sum(CASE WHEN hit THEN upto::DOUBLE / rank ELSE 0 END) AS score, count(*) FILTER (WHERE hit) AS hits FROM c GROUP BY 1)
       SELECT s."user", hits, round(CASE WHEN n IS NULL THEN 1.0 ELSE score / least(n, 10) END, 9) AS average_precision
       FROM s LEFT JOIN (SELECT "user", count(*) AS n FROM a GROUP BY 1) z ON z."user" = s."user\"""",
)
def average_precision(spark, sf):
    """Each customer's most bought products of finished orders, judged against the other orders."""
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity").join(
        table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    named = lines.select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("product"),
        (F.col("o_orderstatus") == "F").alias("past"),
        "l_quantity",
    )
    bought = named.filter("past").groupBy("user", "product").agg(F.sum("l_quantity").alias("q"))
    predicted = top_per_group(bought, ["user"], [F.desc("q"), F.asc("product")], 10)
    found = recommend.average_precision(named.filter(~F.col("past")), predicted, 10)
    return found.withColumn("average_precision", F.round("average_precision", 9))


@query(
    "similar_items",
    """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0)
       SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT q FROM q)), 6) AS similarity FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 11""",
)
def similar_items(spark, sf):
    found = recommend.similar_items(table(spark, sf, "embeddings", "vec_id", "embedding"), 0, 11, "vec_id", "embedding")
    return found.withColumn("similarity", F.round("similarity", 6))


# ---- clusters and components


@query("kmeans_nearest_members")
def kmeans_nearest_members(spark, sf):
    """Clusters of the vectors and the twenty members nearest to each centre."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    model = cluster.fit_kmeans(vectors, k=5, iterations=10)
    near = cluster.nearest_members(cluster.assign(vectors, model), "vec_id", 20)
    return near.select("cluster", "rank", "vec_id", "distance")


@query("kmeans_cost")
def kmeans_cost(spark, sf):
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    model = cluster.fit_kmeans(vectors, k=5, iterations=10)
    return cluster.cluster_cost(cluster.assign(vectors, model)).withColumn("training_cost", F.lit(model.summary.trainingCost))


@query("kmeans_cost_by_k")
def kmeans_cost_by_k(spark, sf):
    return cluster.cost_by_k(table(spark, sf, "embeddings", "vec_id", "embedding"), "vec_id", [2, 3, 5, 10], iterations=5)


@query(
    "labelled_cluster_members",
    """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
       c AS (SELECT label, list(m ORDER BY pos) AS centre FROM (SELECT label, pos, avg(v) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
       d AS (SELECT vec_id, label, list_distance(embedding::DOUBLE[], centre) AS dist FROM embeddings JOIN c USING (label))
       SELECT * FROM (SELECT label AS cluster, vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS INTEGER) AS rank FROM d) WHERE rank <= 20""",
)
def labelled_cluster_members(spark, sf):
    """Given labels as clusters: the members nearest to the mean vector of their label.

    The means are merged from partial sums of each task, so no task holds a cluster.
    """
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding", F.col("label").alias("cluster"))
    near = cluster.nearest_members(cluster.distance_to_mean(vectors), "vec_id", 20)
    return near.select("cluster", "vec_id", "rank")


_SPREAD = """x AS (SELECT generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
  s AS (SELECT sum(m) AS spread FROM (SELECT pos, var_samp(v) * (count(*) - 1) AS m FROM x GROUP BY 1) t)"""


def _width(spark, sf):
    return table(spark, sf, "embeddings", "embedding").agg(F.max(F.size("embedding")).alias("w")).first().w


@query("singular_value_energy", f"WITH {_SPREAD} SELECT round(spread, 4) AS energy FROM s")
def singular_value_energy(spark, sf):
    """The squares of all singular values add up to the squares of the centred values."""
    values = reduce.singular_values(table(spark, sf, "embeddings", "vec_id", "embedding"), _width(spark, sf))
    return values.agg(F.round(F.sum(F.col("singular_value") * F.col("singular_value")), 4).alias("energy"))


# ---- online regression


@query(
    "online_weights",
    """WITH x AS (SELECT vec_id, label::DOUBLE AS y, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)
       SELECT model, pos - 1 AS pos, round(step * sum(y * v) / count(*), 6) AS weight
       FROM x, (VALUES ('slow', 0.01::DOUBLE), ('fast', 1.0::DOUBLE)) m(model, step) GROUP BY model, step, pos""",
)
def online_weights(spark, sf):
    """The trained weights: one gradient step from zero over the batch."""
    vectors = table_stream(spark, sf, "embeddings").select(F.col("label").cast("double").alias("label"), F.col("embedding").alias("features"))
    trained = online.OnlineRegression(spark, work_path(spark, "online"), _width(spark, sf), {"slow": 0.01, "fast": 1.0})
    trained.start(vectors, work_path(spark, "online_state")).awaitTermination()
    return trained.history().select("model", F.posexplode("weights").alias("pos", "w")).select(
        "model", F.col("pos").cast("long").alias("pos"), F.round("w", 6).alias("weight")
    )


@query("online_regression")
def online_regression(spark, sf):
    """Two step sizes trained side by side on a stream of vectors, with their error per batch."""
    vectors = table_stream(spark, sf, "embeddings").select(F.col("label").cast("double").alias("label"), F.col("embedding").alias("features"))
    width = table(spark, sf, "embeddings", "embedding").agg(F.max(F.size("embedding")).alias("w")).first().w
    models_ = online.OnlineRegression(spark, work_path(spark, "online"), width, {"slow": 0.01, "fast": 1.0})
    models_.start(vectors, work_path(spark, "online_state")).awaitTermination()
    return models_.history().select("batch_id", "model", "rows", "mse", "rmse")
