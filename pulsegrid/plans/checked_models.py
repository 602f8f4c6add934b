"""Model queries whose answer has a closed form, so that SQL checks the whole way from training to judgement."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pulsegrid.functions import threshold_label
from pulsegrid.ml import cluster, features, models, recommend, reduce, search
from pulsegrid.operators import filters
from pulsegrid.operators.partitions import spread_out
from pulsegrid.plans.linear import _axes_sql
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import event_readings, rating_triples, table
from pulsegrid.session import durable

# ---- held-out classifiers and regressors: trained before 1999, judged from then on

_NUMBERS = ["quantity", "line", "discount"]
_SPLIT = """rd AS MATERIALIZED (SELECT l_quantity AS quantity, l_linenumber::DOUBLE AS line, floor(l_discount * 100 + 0.5) AS discount,
    l_extendedprice / 1000 AS price, CASE WHEN l_extendedprice >= 40000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, year(l_shipdate) < 1999 AS train FROM lineitem)"""
_HARD = """c AS (SELECT CAST(count(*) FILTER (WHERE y AND p) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE NOT y AND p) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (WHERE NOT y AND NOT p) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y AND NOT p) AS DOUBLE) AS fn FROM p),
    r AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS tpr, CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS fpr,
      CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr, (tp + fn) / (tp + fp + tn + fn) AS base FROM c)"""
_HARD_COLUMNS = """round((tp + tn) / (tp + fp + tn + fn), 9) AS accuracy, round(tpr * pr + (1 - tpr) * (pr + base) / 2, 9) AS pr_area,
    round((1 + tpr - fpr) / 2, 9) AS roc_area"""


def _split(spark, sf, label="label"):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("discount"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        threshold_label("l_extendedprice", 40_000.0).alias("label"),
        F.col("l_shipdate").alias("ts"),
    )
    parts = rows.filter(F.year("ts") < 1999), rows.filter(F.year("ts") >= 1999)
    return [features.assembled(part, _NUMBERS, label) for part in parts]


def _judged(spark, sf, specs):
    train, test = _split(spark, sf)
    found = models.evaluate_all("classify", train, test, specs)
    return found.select("model", *[F.round(c, 9).alias(c) for c in ("accuracy", "pr_area", "roc_area")])


@query(
    "bayes_holdout",
    f"""WITH {_SPLIT}, s AS (SELECT label, count(*) AS n, sum(quantity) AS q, sum(line) AS l, sum(discount) AS d FROM rd WHERE train GROUP BY 1),
      t AS (SELECT label, ln(n + 1.0) AS prior, ln(q + 1) - ln(q + l + d + 3) AS tq, ln(l + 1) - ln(q + l + d + 3) AS tl, ln(d + 1) - ln(q + l + d + 3) AS td FROM s),
      p AS (SELECT rd.label = 1 AS y, b.prior + b.tq * quantity + b.tl * line + b.td * discount > a.prior + a.tq * quantity + a.tl * line + a.td * discount AS p
            FROM rd, t a, t b WHERE NOT train AND a.label = 0 AND b.label = 1), {_HARD}
      SELECT 'bayes' AS model, {_HARD_COLUMNS} FROM r""",
)
def bayes_holdout(spark, sf):
    return _judged(spark, sf, {"bayes": {"smoothing": 1.0}})


def _stump_sql(impurity):
    """The best split of all columns between neighbouring values, and the majority on either side."""
    of = {
        "gini": lambda p, n: f"(1 - pow({p}::DOUBLE / {n}, 2) - pow(1 - {p}::DOUBLE / {n}, 2))",
        "entropy": lambda p, n: f"(-({_plogp(p, n)}) - ({_plogp(f'({n} - {p})', n)}))",
    }[impurity]
    return f"""x AS (SELECT label, unnest([0, 1, 2]) AS f, unnest([quantity, line, discount]) AS v FROM rd WHERE train),
      g AS (SELECT f, v, sum(label) AS p, count(*) AS n FROM x GROUP BY 1, 2),
      h AS (SELECT f, v, lead(v) OVER o AS nextv, sum(p) OVER o AS lp, sum(n) OVER o AS ln_, sum(p) OVER (PARTITION BY f) AS tp, sum(n) OVER (PARTITION BY f) AS tn
            FROM g WINDOW o AS (PARTITION BY f ORDER BY v)),
      b AS (SELECT f, (v + nextv) / 2 AS cut, lp > ln_ - lp AS left_said, tp - lp > (tn - ln_) - (tp - lp) AS right_said,
                   {of('tp', 'tn')} - ln_ / tn * {of('lp', 'ln_')} - (tn - ln_) / tn * {of('(tp - lp)', '(tn - ln_)')} AS gain
            FROM h WHERE nextv IS NOT NULL ORDER BY gain DESC LIMIT 1)"""


def _plogp(p, n):
    return f"CASE WHEN {p} > 0 THEN {p}::DOUBLE / {n} * log2({p}::DOUBLE / {n}) ELSE 0 END"


@query(
    "stump_holdout",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH {_SPLIT}, {_stump_sql(impurity)},
      p AS (SELECT label = 1 AS y, CASE WHEN [quantity, line, discount][f + 1] <= cut THEN left_said ELSE right_said END AS p FROM rd, b WHERE NOT train), {_HARD}
      SELECT '{name}' AS model, {_HARD_COLUMNS} FROM r)"""
        for name, impurity in (("gini", "gini"), ("entropy", "entropy"), ("forest", "gini"))
    ),
)
def stump_holdout(spark, sf):
    """Trees of one split by both impurities, and a forest of three that see all rows and columns; 64 bins hold every value."""
    stump = {"maxDepth": 1, "maxBins": 64}
    specs = {i: {"model": "tree", "impurity": i, **stump} for i in ("gini", "entropy")}
    specs["forest"] = {"impurity": "gini", "numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all", **stump}
    return _judged(spark, sf, specs)


@query(
    "regression_stump_holdout",
    f"""WITH {_SPLIT}, x AS (SELECT price, unnest([0, 1, 2]) AS f, unnest([quantity, line, discount]) AS v FROM rd WHERE train),
      g AS (SELECT f, v, sum(price) AS s, count(*) AS n FROM x GROUP BY 1, 2),
      h AS (SELECT f, v, lead(v) OVER o AS nextv, sum(s) OVER o AS ls, sum(n) OVER o AS ln_, sum(s) OVER (PARTITION BY f) AS ts, sum(n) OVER (PARTITION BY f) AS tn
            FROM g WINDOW o AS (PARTITION BY f ORDER BY v)),
      b AS (SELECT f, (v + nextv) / 2 AS cut, ls / ln_ AS left_mean, (ts - ls) / (tn - ln_) AS right_mean
            FROM h WHERE nextv IS NOT NULL ORDER BY ls * ls / ln_ + (ts - ls) * (ts - ls) / (tn - ln_) DESC LIMIT 1),
      p AS (SELECT price AS y, CASE WHEN [quantity, line, discount][f + 1] <= cut THEN left_mean ELSE right_mean END AS p FROM rd, b WHERE NOT train)
      SELECT 'tree' AS model, round(avg((p - y) * (p - y)), 6) AS mse, round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg(pow(ln(p + 1) - ln(y + 1), 2))), 6) AS rmsle FROM p""",
)
def regression_stump_holdout(spark, sf):
    """A regression tree of one split: the means of both sides."""
    train, test = _split(spark, sf, "price")
    found = models.evaluate_all("regress", train, test, {"tree": {"maxDepth": 1, "maxBins": 64}})
    return found.select("model", *[F.round(c, 6).alias(c) for c in ("mse", "mae", "rmsle")])


@query(
    "linear_holdout",
    f"""WITH {_SPLIT}, f AS (SELECT regr_slope(price, quantity) AS a, regr_intercept(price, quantity) AS b, regr_slope(ln(price), quantity) AS la, regr_intercept(ln(price), quantity) AS lb FROM rd WHERE train),
      p AS (SELECT price AS y, unnest(['linear', 'log']) AS model, unnest([a * quantity + b, exp(la * quantity + lb)]) AS p FROM rd, f WHERE NOT train)
      SELECT model, round(avg((p - y) * (p - y)), 6) AS mse, round(avg(abs(p - y)), 6) AS mae FROM p GROUP BY 1""",
)
def linear_holdout(spark, sf):
    """One-feature regressions of the price and of its logarithm, both judged on the price scale."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / 1000).alias("price"), F.year("l_shipdate").alias("year")
    )
    parts = [features.assembled(part, ["quantity"], "price") for part in (rows.filter("year < 1999"), rows.filter("year >= 1999"))]
    straight = models.estimator("regress", "linear", solver="normal").fit(parts[0]).transform(parts[1])
    logged = [part.withColumn("label", F.log("label")) for part in parts]
    log = models.log_label_metrics(models.estimator("regress", "linear", solver="normal").fit(logged[0]).transform(logged[1]))
    both = models.metrics_of("regress", straight).withColumn("model", F.lit("linear")).unionByName(log.withColumn("model", F.lit("log")))
    return both.select("model", F.round("mse", 6).alias("mse"), F.round("mae", 6).alias("mae"))


# ---- encoding with the time of day, and classes at requested times

_SLOTS = """ev AS MATERIALIZED (SELECT event_id, hour(ts)::VARCHAR AS hour, minute(ts)::VARCHAR AS minute, event_type, floor(value * 100 + 0.5) AS price FROM events),
  ct AS (SELECT 0 AS c, hour AS v FROM ev UNION SELECT 1, minute FROM ev UNION SELECT 2, event_type FROM ev),
  wd AS (SELECT c, count(*) + 1 AS width FROM ct GROUP BY 1),
  sl AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) - 1 + coalesce((SELECT sum(width) FROM wd WHERE wd.c < ct.c), 0) AS pos FROM ct)"""


def _timed_events(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type", F.floor(F.col("value") * 100 + 0.5).cast("double").alias("price"))
    return features.with_time_parts(rows)


@query(
    "one_hot_slots",
    f"""WITH {_SLOTS}, o AS (SELECT pos, 1.0::DOUBLE AS x FROM ev JOIN sl ON (c = 0 AND v = hour) OR (c = 1 AND v = minute) OR (c = 2 AND v = event_type)
          UNION ALL SELECT (SELECT sum(width) FROM wd), price FROM ev)
        SELECT CAST(pos AS BIGINT) AS pos, sum(x) AS total, count(*) AS n FROM o WHERE x <> 0 GROUP BY 1""",
)
def one_hot_slots(spark, sf):
    """Every slot of the encoded events, hour and minute among the categories: how often it is set, and its sum."""
    rows = _timed_events(spark, sf)
    coded = features.one_hot_pipeline(["hour", "minute", "event_type"], ["price"]).fit(rows).transform(rows)
    slots = coded.select(F.posexplode(vector_to_array("features")).alias("pos", "x")).filter("x <> 0")
    return slots.groupBy(F.col("pos").cast("long").alias("pos")).agg(F.sum("x").alias("total"), F.count("*").alias("n"))


@query(
    "classify_at_times",
    """WITH rd AS MATERIALIZED (SELECT l_shipdate AS ts, year(l_shipdate) AS a, month(l_shipdate) AS b, day(l_shipdate) AS c,
             CASE WHEN l_extendedprice >= 40000 THEN 1 ELSE 0 END AS label, l_extendedprice / 1000 AS price FROM lineitem),
      w AS (SELECT count(DISTINCT a) + count(DISTINCT b) + count(DISTINCT c) + 3 AS width FROM rd),
      x AS (SELECT label, 0 AS f, a AS v FROM rd UNION ALL SELECT label, 1, b FROM rd UNION ALL SELECT label, 2, c FROM rd),
      pr AS (SELECT label, ln(count(*) + 1.0) AS prior, 3 * count(*) AS total FROM rd GROUP BY 1),
      kn AS (SELECT DISTINCT f, v FROM x),
      th AS (SELECT kn.f, kn.v, pr.label, ln(count(x.label) + 1.0) - ln(total + (SELECT width FROM w)) AS theta
             FROM kn CROSS JOIN pr LEFT JOIN x ON x.f = kn.f AND x.v = kn.v AND x.label = pr.label GROUP BY 1, 2, 3, total),
      rq AS (SELECT o_orderkey, o_orderdate AS ts, [year(o_orderdate), month(o_orderdate), day(o_orderdate)] AS parts FROM orders),
      un AS (SELECT label, -ln(total + (SELECT width FROM w)) AS unseen FROM pr),
      sc AS (SELECT o_orderkey, pr.label, prior + sum(coalesce(theta, unseen)) AS score
             FROM (SELECT o_orderkey, unnest([0, 1, 2]) AS f, unnest(parts) AS v FROM rq) q CROSS JOIN pr JOIN un USING (label)
             LEFT JOIN th ON th.f = q.f AND th.v = q.v AND th.label = pr.label GROUP BY 1, 2, prior),
      bs AS (SELECT o_orderkey, CAST(arg_max(label, score) AS DOUBLE) AS prediction FROM sc GROUP BY 1),
      ac AS (SELECT ts, count(*) AS matches, min(price) AS actual FROM rd GROUP BY 1)
    SELECT o_orderkey, prediction, CASE WHEN coalesce(actual, 0) >= 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS actual_label,
           CASE WHEN matches IS NULL THEN 'missing' WHEN matches = 1 THEN 'one' ELSE 'duplicated' END AS outcome
    FROM rq JOIN bs USING (o_orderkey) LEFT JOIN ac ON ac.ts = rq.ts""",
)
def classify_at_times(spark, sf):
    """Order dates as requested times: the class that naive Bayes gives them, and the class of the reading at that time."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        threshold_label("l_extendedprice", 40_000.0).alias("label"),
    )
    rows = features.with_time_parts(rows)
    encoder = features.one_hot_pipeline(["year", "month", "day"], []).fit(rows)
    fitted = models.estimator("classify", "bayes", smoothing=1.0).fit(encoder.transform(rows))
    requests = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    known = filters.point_lookup(requests, rows, "ts", "price")
    answers = models.classify_at(encoder, fitted, features.with_time_parts(known), 40.0)
    return answers.select("o_orderkey", "prediction", "actual_label", "outcome")


# ---- clusters and components


@query(
    "given_centres",
    """WITH c AS (SELECT vec_id AS cluster, embedding::DOUBLE[] AS centre FROM embeddings WHERE vec_id < 5),
      d AS (SELECT vec_id, cluster, pow(list_distance(embedding::DOUBLE[], centre), 2) AS d FROM embeddings, c),
      n AS (SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM d GROUP BY 1)
    SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, round(sum(d), 4) AS cost FROM n GROUP BY 1""",
)
def given_centres(spark, sf):
    """Members and cost of clusters around given centres, the first five vectors."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    centres = [list(r.embedding) for r in vectors.filter("vec_id < 5").orderBy("vec_id").collect()]
    placed = cluster.assign_to(vectors, centres)
    return placed.groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.sum("distance"), 4).alias("cost"))



@query(
    "principal_components",
    f"WITH {_axes_sql(8)} "
    + " UNION ALL ".join(f"SELECT {c} AS component, round(l / (SELECT sum(v) FROM gram WHERE i = j), 7) AS share FROM l{c}" for c in range(1, 9)),
)
def principal_components(spark, sf):
    model, _ = reduce.pca_projection(table(spark, sf, "embeddings", "vec_id", "embedding"), 8)
    return reduce.component_rows(model, spark).select("component", F.round("share", 7).alias("share"))


@query(
    "pca_projection",
    f"WITH {_axes_sql(8)} "
    + " UNION ALL ".join(f"SELECT vec_id, {c} AS axis, round(abs(sum(c.v * v{c}.v)), 4) AS distance FROM c JOIN v{c} ON c.pos = v{c}.i GROUP BY 1" for c in range(1, 9)),
)
def pca_projection(spark, sf):
    """Each vector's distance from the mean along the first eight axes, whose signs are free."""
    _, projected = reduce.pca_projection(table(spark, sf, "embeddings", "vec_id", "embedding"), 8)
    axes = projected.select("vec_id", F.posexplode("projection").alias("at", "x"))
    return axes.select("vec_id", (F.col("at") + 1).alias("axis"), F.round(F.abs("x"), 4).alias("distance"))


# ---- exact inner-product search: every fiftieth vector asks all vectors

_PRODUCTS = """q AS (SELECT vec_id AS "user", label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0),
  a AS MATERIALIZED (SELECT q."user", v.vec_id AS product, list_dot_product(q.e, v.embedding::DOUBLE[]) AS score, q.label = v.label AS own FROM q, embeddings v),
  r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, product) AS rank FROM a)"""


def _askers(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")
    return vectors.filter(F.col("id") % 50 == 0), vectors


@query("best_products", f'WITH {_PRODUCTS} SELECT "user", rank, product, round(score, 6) AS score FROM r WHERE rank <= 10')
def best_products(spark, sf):
    """The ten largest inner products, by blocks of falling length."""
    users, items = _askers(spark, sf)
    found = search.best_items(users, items, 10)
    return found.withColumn("score", F.round("score", 6))


#: Items that one task pairs with the askers of their label.
_PIECE_ITEMS = 8192


def _owned(users, items):
    mine = users.select(F.col("id").alias("user"), "label")
    things = spread_out(items.select(F.col("id").alias("product"), "label"), _PIECE_ITEMS)
    return things.join(mine, "label").select("user", "product")


@query("owned_product_ranks", f'WITH {_PRODUCTS} SELECT "user", product, rank FROM r WHERE own')
def owned_product_ranks(spark, sf):
    """Place of every vector of the asker's own label among all vectors, by counting those above it."""
    users, items = _askers(spark, sf)
    return search.item_ranks(users, items, _owned(users, items)).select("user", "product", "rank")


@query(
    "whole_ranking_precision",
    f"""WITH {_PRODUCTS}, o AS (SELECT "user", rank, row_number() OVER (PARTITION BY "user" ORDER BY rank) AS upto FROM r WHERE own)
        SELECT "user", round(sum(upto::DOUBLE / rank) / count(*), 9) AS average_precision, count(*) AS owned,
               round(sum(CASE WHEN rank <= 100 THEN upto::DOUBLE / rank ELSE 0 END) / least(count(*), 100), 9) AS at_hundred FROM o GROUP BY 1""",
)
def whole_ranking_precision(spark, sf):
    """Average precision of the whole ranking and of its first hundred places."""
    users, items = _askers(spark, sf)
    ranks = search.item_ranks(users, items, _owned(users, items))  # stored by the search
    whole, first = search.whole_ranking_precision(ranks), search.whole_ranking_precision(ranks, 100)
    first = first.select("user", F.round("average_precision", 9).alias("at_hundred"))
    return whole.withColumn("average_precision", F.round("average_precision", 9)).join(first, "user")


@query("als_ranking_map")
def als_ranking_map(spark, sf):
    """Mean average precision over whole rankings of all products, and at 2000, of a factor model."""
    ratings = durable(rating_triples(spark, sf))
    model = recommend.train_als(ratings, rank=10, iterations=3, reg=0.1)
    ranks = search.item_ranks(model.userFactors, model.itemFactors, ratings)  # stored by the search
    whole, first = search.whole_ranking_precision(ranks), search.whole_ranking_precision(ranks, 2000)
    at = first.select("user", F.col("average_precision").alias("at_2000"))
    return whole.join(at, "user").agg(F.avg("average_precision").alias("ranking_map"), F.avg("at_2000").alias("map_at_2000"), F.count("*").alias("users"))


@query(
    "gappy_minute_profile",
    """WITH e AS (SELECT event_id, floor(value * 100 + 0.5) AS label, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute, event_type = 'purchase' AS train FROM events),
      p AS (SELECT minute, sum(label) / count(*) AS m FROM e WHERE train GROUP BY 1), a AS (SELECT sum(label) / count(*) AS m FROM e WHERE train),
      s AS (SELECT label, coalesce(p.m, a.m) AS prediction FROM e LEFT JOIN p USING (minute), a WHERE NOT train)
    SELECT count(*) AS rows, round(avg((prediction - label) * (prediction - label)), 4) AS mse, round(avg(abs(prediction - label)), 6) AS mae FROM s""",
)
def gappy_minute_profile(spark, sf):
    """A profile of the purchases only, whose minutes without any predict the mean of all; every other event is judged."""
    rows = event_readings(spark, sf).join(table(spark, sf, "events", "event_id", "event_type"), "event_id")
    bought = F.col("event_type") == "purchase"
    scored = models.minute_predictions(rows.filter(bought), rows.filter(~bought), "active_kw")
    error = F.col("prediction") - F.col("label")
    return scored.agg(F.count("*").alias("rows"), F.round(F.avg(error * error), 4).alias("mse"), F.round(F.avg(F.abs(error)), 6).alias("mae"))
