"""Queries of the linear algebra: singular vectors, gradient descent, wide streaming regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import counted_slots, same_direction, threshold_label, word_tokens
from pulsegrid.ml import descent, online, reduce
from pulsegrid.plans.registry import query
from pulsegrid.plans.streams import table_stream
from pulsegrid.plans.tables import table
from pulsegrid.session import work_path

# ---- singular value decomposition of the embeddings


def _vectors(spark, sf):
    return table(spark, sf, "embeddings", "vec_id", "embedding")


_GRAM = """x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
  c AS (SELECT vec_id, pos, v - avg(v) OVER (PARTITION BY pos) AS v FROM x),
  gram AS MATERIALIZED (SELECT a.pos AS i, b.pos AS j, sum(a.v * b.v) AS v FROM c a JOIN c b USING (vec_id) GROUP BY 1, 2)"""


def _axes_sql(k, squarings=16):
    """The first axes by squaring the Gram matrix until its first axis alone is left, then taking that axis out."""
    parts = [_GRAM]
    for c in range(1, k + 1):
        base = "gram" if c == 1 else f"left{c - 1}"
        parts.append(f"m{c}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM {base} WHERE i = j) AS v FROM {base})")
        for s in range(1, squarings + 1):
            square = f"SELECT a.i, b.j, sum(a.v * b.v) AS v FROM m{c}_{s - 1} a JOIN m{c}_{s - 1} b ON a.j = b.i GROUP BY 1, 2"
            parts.append(f"q{c}_{s} AS MATERIALIZED ({square})")
            parts.append(f"m{c}_{s} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM q{c}_{s} WHERE i = j) AS v FROM q{c}_{s})")
        last = f"m{c}_{squarings}"
        parts.append(
            f"v{c} AS MATERIALIZED (SELECT i, v / sqrt((SELECT max(v) FROM {last} WHERE i = j)) AS v FROM {last}"
            f" WHERE j = (SELECT arg_max(i, v) FROM {last} WHERE i = j))"
        )
        parts.append(f"l{c} AS MATERIALIZED (SELECT sum(a.v * g.v * b.v) AS l FROM {base} g JOIN v{c} a ON a.i = g.i JOIN v{c} b ON b.i = g.j)")
        parts.append(
            f"left{c} AS MATERIALIZED (SELECT g.i, g.j, g.v - (SELECT l FROM l{c}) * a.v * b.v AS v"
            f" FROM {base} g JOIN v{c} a ON a.i = g.i JOIN v{c} b ON b.i = g.j)"
        )
    return ", ".join(parts)


@query(
    "singular_values",
    f"WITH {_axes_sql(8)} " + " UNION ALL ".join(f"SELECT {c}::INTEGER AS component, round(sqrt(l), 5) AS singular_value FROM l{c}" for c in range(1, 9)),
)
def singular_values(spark, sf):
    found = reduce.singular_values(_vectors(spark, sf), 8)
    return found.withColumn("singular_value", F.round("singular_value", 5))


@query(
    "singular_vectors",
    f"WITH {_axes_sql(3)} " + " UNION ALL ".join(f"SELECT {c}::INTEGER AS component, i AS pos, round(abs(v), 5) AS loading FROM v{c}" for c in range(1, 4)),
)
def singular_vectors(spark, sf):
    """Absolute loadings of the first three right singular vectors."""
    rows = reduce.svd_rows(spark, reduce.centred_svd(_vectors(spark, sf), 3))
    loadings = rows.select("component", F.posexplode("axis").alias("pos", "x"))
    return loadings.select("component", (F.col("pos") + 1).cast("long").alias("pos"), F.round(F.abs("x"), 5).alias("loading"))


@query("svd_gram_matrix", f"WITH {_GRAM} SELECT i, j, round(v, 6) AS value FROM gram")
def svd_gram_matrix(spark, sf):
    """All singular values and axes put together again: the squares of the centred table."""
    rows = reduce.svd_rows(spark, reduce.centred_svd(_vectors(spark, sf), _width(spark, sf)))
    axes = rows.select("component", (F.col("singular_value") * F.col("singular_value")).alias("l"), F.posexplode("axis").alias("pos", "x"))
    left = axes.select("component", "l", (F.col("pos") + 1).cast("long").alias("i"), "x")
    right = axes.select("component", (F.col("pos") + 1).cast("long").alias("j"), F.col("x").alias("y"))
    products = left.join(right, "component").groupBy("i", "j").agg(F.sum(F.col("l") * F.col("x") * F.col("y")).alias("value"))
    return products.select("i", "j", (F.round("value", 6) + 0.0).alias("value"))


@query("svd_projection", "SELECT vec_id, true AS same FROM embeddings")
def svd_projection(spark, sf):
    """U times the singular values is, up to the signs of the axes, the projection on the principal components."""
    vectors = _vectors(spark, sf)
    svd = reduce.centred_svd(vectors, 8)
    values = F.array(*[F.lit(float(s)) for s in svd.values])
    left = reduce.left_vectors(vectors, svd).select("vec_id", F.zip_with("u", values, lambda u, s: u * s).alias("by_svd"))
    _, projected = reduce.pca_projection(vectors, 8)
    both = left.join(projected.select("vec_id", "projection"), "vec_id")
    return both.select("vec_id", same_direction("by_svd", "projection").alias("same"))


@query(
    "left_singular_vectors",
    "SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product"
    " FROM range(1, 9) x(a), range(1, 9) y(b)",
)
def left_singular_vectors(spark, sf):
    """The left vectors are orthonormal: their products over all rows are those of the unit matrix."""
    vectors = _vectors(spark, sf)
    u = reduce.left_vectors(vectors, reduce.centred_svd(vectors, 8)).select(F.posexplode("u").alias("a", "x"), "u")
    pairs = u.select((F.col("a") + 1).alias("a"), "x", F.posexplode("u").alias("b", "y"))
    sums = pairs.groupBy("a", (F.col("b") + 1).alias("b")).agg(F.sum(F.col("x") * F.col("y")).alias("product"))
    return sums.withColumn("product", F.round("product", 8) + 0.0)


def _width(spark, sf):
    return table(spark, sf, "embeddings", "embedding").agg(F.max(F.size("embedding")).alias("w")).first().w


# ---- gradient descent: lines above a price, from quantity, line number, discount and tax


def _points(spark, sf):
    lines = table(spark, sf, "lineitem")
    features = [F.lit(1.0), F.col("l_quantity") / 25 - 1, F.col("l_linenumber") / 4 - 1, F.col("l_discount") * 20 - 1, F.col("l_tax") * 25 - 1]
    return lines.select(
        threshold_label("l_extendedprice", 40_000.0).alias("label"), F.array(*features).alias("features"), F.year("l_shipdate").alias("year")
    )


_WIDTH = 5
_POINTS = """pt AS MATERIALIZED (SELECT CASE WHEN l_extendedprice >= 40000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, 1.0::DOUBLE AS x0, l_quantity / 25 - 1 AS x1,
   l_linenumber / 4.0::DOUBLE - 1 AS x2, l_discount * 20 - 1 AS x3, l_tax * 25 - 1 AS x4, year(l_shipdate) AS yr FROM lineitem)"""


def _descent_sql(settings, rounds, where="true"):
    """The weights after each round, one table ``w0`` to ``w<rounds>`` of a row per setting, by plain aggregation."""
    dims = range(_WIDTH)
    values = ", ".join(f"('{n}', '{s.loss}', '{s.updater}', {s.step}::DOUBLE, {s.reg}::DOUBLE)" for n, s in settings.items())
    zeros = ", ".join(f"0.0::DOUBLE AS w{i}" for i in dims)
    parts = [_POINTS, f"w_0 AS (SELECT *, {zeros} FROM (VALUES {values}) s(model, loss, updater, step, reg))"]
    margin = " + ".join(f"w{i} * x{i}" for i in dims)
    for t in range(1, rounds + 1):
        factor = f"""CASE loss WHEN 'squared' THEN z - y WHEN 'logistic' THEN 1 / (1 + exp(-z)) - y
          ELSE CASE WHEN (2 * y - 1) * z < 1 THEN 1 - 2 * y ELSE 0 END END"""
        means = ", ".join(f"avg(f * x{i}) AS g{i}" for i in dims)
        carried = ", ".join(f"any_value(w{i}) AS w{i}" for i in dims)
        rate = f"(step / sqrt({t}))"

        def update(i, rate=rate):
            moved = f"w{i} - {rate} * g{i}"
            shrunk = f"sign({moved}) * greatest(abs({moved}) - {rate} * reg, 0)"
            return f"CASE updater WHEN 'l1' THEN {shrunk} WHEN 'l2' THEN (1 - {rate} * reg) * w{i} - {rate} * g{i} ELSE {moved} END AS w{i}"

        parts.append(f"z_{t} AS (SELECT *, {margin} AS z FROM pt, w_{t - 1} WHERE {where})")
        parts.append(
            f"g_{t} AS MATERIALIZED (SELECT model, loss, updater, step, reg, {means}, {carried} FROM (SELECT *, {factor} AS f FROM z_{t}) t"
            " GROUP BY model, loss, updater, step, reg)"
        )
        parts.append(f"w_{t} AS MATERIALIZED (SELECT model, loss, updater, step, reg, {', '.join(update(i) for i in dims)} FROM g_{t})")
    return ", ".join(parts)


_GRID = {
    f"{loss}_{updater}": descent.Setting(loss, updater, 1.0, 0.0 if updater == "none" else 0.05)
    for loss in descent.LOSSES
    for updater in descent.UPDATERS
}


@query(
    "gradient_steps",
    f"WITH {_descent_sql(_GRID, 3)} "
    + " UNION ALL ".join(f"SELECT model, {t} AS round, {i} AS pos, round(w{i}, 8) AS weight FROM w_{t}" for t in (1, 2, 3) for i in range(_WIDTH)),
)
def gradient_steps(spark, sf):
    """Weights of three losses with three updaters after one, two and three rounds over all rows."""
    points = _points(spark, sf).persist()
    out = None
    for t in (1, 2, 3):
        rows = descent.weight_rows(spark, descent.descend(points, _GRID, _WIDTH, t)).withColumn("round", F.lit(t))
        out = rows if out is None else out.unionByName(rows)
    points.unpersist()
    return out.select("model", "round", "pos", (F.round("weight", 8) + 0.0).alias("weight"))


def _report_sql(settings, rounds):
    """Confusion counts and accuracy on the later years of models trained on the earlier ones."""
    margin = " + ".join(f"w{i} * x{i}" for i in range(_WIDTH))
    return f"""WITH {_descent_sql(settings, rounds, "yr < 1999")},
      s AS (SELECT model, y = 1 AS pos, {margin} > 0 AS said FROM pt, w_{rounds} WHERE yr >= 1999)
      SELECT model, count(*) FILTER (WHERE pos AND said) AS tp, count(*) FILTER (WHERE NOT pos AND said) AS fp,
             count(*) FILTER (WHERE NOT pos AND NOT said) AS tn, count(*) FILTER (WHERE pos AND NOT said) AS fn,
             round(avg(CASE WHEN pos = said THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy FROM s GROUP BY 1"""


def _swept(spark, sf, settings, rounds):
    points = _points(spark, sf)
    train = points.filter("year < 1999").persist()
    found = descent.descend(train, settings, _WIDTH, rounds)
    train.unpersist()
    report = descent.sweep_report(points.filter("year >= 1999"), found)
    return report.select("model", "tp", "fp", "tn", "fn", F.round("accuracy", 9).alias("accuracy"))


_STEPS = {f"step={s}": descent.Setting("logistic", "none", s) for s in (0.001, 0.01, 0.1, 1.0, 10.0)}
_REGS = {f"{u}={r}": descent.Setting("logistic", u, 1.0, r) for u in ("l1", "l2") for r in (0.001, 0.01, 0.1, 1.0)}
_HINGES = {f"hinge {u} step={s}": descent.Setting("hinge", u, s, 0.01) for u in ("none", "l1", "l2") for s in (0.1, 1.0)}


@query("step_sweep", _report_sql(_STEPS, 10))
def step_sweep(spark, sf):
    """Step sizes of logistic regression, all trained in the same ten passes."""
    return _swept(spark, sf, _STEPS, 10)


@query("updater_sweep", _report_sql(_REGS, 10))
def updater_sweep(spark, sf):
    """L1 and L2 penalties of logistic regression."""
    return _swept(spark, sf, _REGS, 10)


@query("hinge_sweep", _report_sql(_HINGES, 10))
def hinge_sweep(spark, sf):
    """Updaters and step sizes of the linear machine."""
    return _swept(spark, sf, _HINGES, 10)


# ---- wide streaming regression: the number of a turn from its words, 2000 hashed features

_WIDE = 2000
_WORD_SLOTS = rf"""tk AS (SELECT conv_id, turn, CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) % {_WIDE} AS pos
    FROM (SELECT conv_id, turn, unnest(string_split_regex(text, '\s+')) AS word FROM conversations) w WHERE word <> ''),
  xs AS MATERIALIZED (SELECT conv_id, turn, pos, count(*)::DOUBLE AS x FROM tk GROUP BY 1, 2, 3),
  ys AS (SELECT conv_id, turn, turn::DOUBLE AS y FROM conversations)"""


def _turns(spark, sf):
    """Each turn as the sorted slots of its words and how often they occur."""
    slot = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long"), F.lit(_WIDE)).cast("int")
    turns = table_stream(spark, sf, "conversations").select(F.col("turn").cast("double").alias("label"), F.transform(word_tokens("text"), slot).alias("slots"))
    return turns.select("label", counted_slots("slots").alias("features"))


def _wide_models(spark, sf, iterations):
    models = online.OnlineRegression(spark, work_path(spark, "wide"), _WIDE, {"slow": 0.0005, "fast": 0.002}, iterations)
    models.start(_turns(spark, sf), work_path(spark, "wide_state")).awaitTermination()
    return models.history()


_TWO_STEPS = f"""{_WORD_SLOTS}, md AS (SELECT * FROM (VALUES ('slow', 0.0005::DOUBLE), ('fast', 0.002::DOUBLE)) m(model, step)),
  n AS (SELECT count(*) AS n FROM ys),
  w1 AS MATERIALIZED (SELECT model, step, pos, step * sum(y * x) / (SELECT n FROM n) AS w FROM xs JOIN ys USING (conv_id, turn), md GROUP BY 1, 2, 3),
  e2 AS MATERIALIZED (SELECT model, conv_id, turn, sum(x * w) AS z FROM xs JOIN w1 USING (pos) GROUP BY 1, 2, 3),
  g2 AS (SELECT model, pos, sum((z - y) * x) AS g FROM e2 JOIN ys USING (conv_id, turn) JOIN xs USING (conv_id, turn) GROUP BY 1, 2),
  w2 AS (SELECT model, pos, w - step / sqrt(2) * g / (SELECT n FROM n) AS w FROM w1 JOIN g2 USING (model, pos))"""


@query("wide_regression_weights", f"WITH {_TWO_STEPS} SELECT model, pos, round(w, 8) AS weight FROM w2 WHERE round(w, 8) <> 0")
def wide_regression_weights(spark, sf):
    """Weights of two models with 2,000 features after two steps over a batch of the stream."""
    history = _wide_models(spark, sf, 2)
    weights = history.select("model", F.posexplode("weights").alias("pos", "w"))
    found = weights.select("model", F.col("pos").cast("long").alias("pos"), (F.round("w", 8) + 0.0).alias("weight"))
    return found.where("weight <> 0")


@query(
    "wide_regression_errors",
    "SELECT model, n AS rows, round(s / n, 8) AS mse, round(sqrt(s / n), 8) AS rmse"
    " FROM (SELECT count(*) AS n, sum(turn::DOUBLE * turn) AS s FROM conversations) t, (VALUES ('slow'), ('fast')) m(model)",
)
def wide_regression_errors(spark, sf):
    """Errors of both models on the batch, with the weights from before it (all zero)."""
    history = _wide_models(spark, sf, 1)
    return history.select("model", "rows", F.round("mse", 8).alias("mse"), F.round("rmse", 8).alias("rmse"))
