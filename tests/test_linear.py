"""Vector sums, singular vectors, gradient descent and inner-product search against numpy."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.functions import counted_slots
from pulsegrid.ml import descent, online, reduce, search
from pulsegrid.ml.blocks import Block, sum_blocks
from pulsegrid.operators.ranking import top_per_group
from pulsegrid.operators.rank_select import bucketed_median, quantile_rank
from pulsegrid.plans.linear import _turns


def vectors(spark, matrix, parts=7):
    data = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(data, "id long, features array<double>").repartition(parts)


def test_sum_over_dense_and_sparse_rows(spark):
    rng = np.random.default_rng(0)
    matrix = rng.integers(-3, 4, (90, 12)).astype(float)
    dense = vectors(spark, matrix)
    places = F.filter(F.sequence(F.lit(0), F.lit(11)), lambda i: F.get("features", i) != 0)
    sparse = dense.select(F.struct(places.alias("indices"), F.transform(places, lambda i: F.get("features", i)).alias("values")).alias("features"))
    for df in (dense.select("features"), sparse):
        found = sum_blocks(df, lambda batch: Block(batch.column("features"), 12).weighted(np.ones((batch.num_rows, 2))))
        assert np.allclose(found.reshape(2, 12), matrix.sum(0))
        weights = rng.normal(size=(3, 12))
        products = sum_blocks(df, lambda batch: (Block(batch.column("features"), 12).times(weights) ** 2).sum(0))  # noqa: B023
        assert np.allclose(products, ((matrix @ weights.T) ** 2).sum(0))
    assert sum_blocks(dense.filter("id < 0").select("features"), lambda batch: np.ones(1)) is None


@pytest.mark.parametrize("rows_, width, fan", [(200, 6, 16), (40, 5, 1), (3, 8, 16), (1, 2, 16)])
def test_svd_equals_numpy(spark, rows_, width, fan, monkeypatch):
    monkeypatch.setattr(reduce, "TREE_FAN", fan)
    matrix = np.random.default_rng(rows_).normal(2.0, 1.0, (rows_, width)) * np.arange(1, width + 1)
    centred = matrix - matrix.mean(0)
    u, s, v = np.linalg.svd(centred, full_matrices=False)
    k = min(3, width)
    found = reduce.centred_svd(vectors(spark, matrix), k, "features")
    assert found.rows == rows_ and np.allclose(found.mean, matrix.mean(0))
    values = np.concatenate((s, np.zeros(width)))[:k]
    assert np.allclose(found.values, values, atol=1e-9)
    left = reduce.left_vectors(vectors(spark, matrix), found, "features").orderBy("id").collect()
    shares = np.array([r.u for r in left])
    real = values > 1e-9
    assert np.allclose(np.abs(found.axes[real]), np.abs(v[:k][real[: len(v[:k])]]), atol=1e-8)
    assert np.allclose(shares * found.values, centred @ found.axes.T * real, atol=1e-8)
    assert all(a[np.abs(a).argmax()] > 0 for a in found.axes)


def test_svd_of_nothing(spark):
    with pytest.raises(ValueError):
        reduce.centred_svd(spark.createDataFrame([], "id long, features array<double>"), 2, "features")


def _plain_descent(x, y, setting, rounds):
    w = np.zeros(x.shape[1])
    for t in range(1, rounds + 1):
        total = np.zeros_like(w)
        for a, label in zip(x, y):
            z = a @ w
            if setting.loss == "squared":
                total += (z - label) * a
            elif setting.loss == "logistic":
                total += (1 / (1 + np.exp(-z)) - label) * a
            elif (2 * label - 1) * z < 1:
                total -= (2 * label - 1) * a
        rate = setting.step / np.sqrt(t)
        moved = w - rate * total / len(x)
        if setting.updater == "l1":
            moved = np.array([np.sign(m) * max(0, abs(m) - rate * setting.reg) for m in moved])
        w = moved - rate * setting.reg * w if setting.updater == "l2" else moved
    return w


def _labelled(spark, n=300):
    rng = np.random.default_rng(4)
    x = np.column_stack((np.ones(n), rng.normal(size=(n, 3))))
    y = (x @ [0.2, 1.5, -1.0, 0.0] > 0).astype(float)
    data = [(float(b), [float(v) for v in a]) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(data, "label double, features array<double>").repartition(6)


def test_all_losses_and_updaters_in_the_same_passes(spark):
    x, y, points = _labelled(spark)
    settings = {f"{a}/{b}": descent.Setting(a, b, 0.7, 0.1) for a in descent.LOSSES for b in descent.UPDATERS}
    found = descent.descend(points, settings, 4, 5)
    for name, setting in settings.items():
        assert np.allclose(found.weights[name], _plain_descent(x, y, setting, 5)), name
    assert len(found.losses) == 5 and all(found.losses[-1][m] <= found.losses[0][m] for m in settings)
    report = {r.model: r for r in descent.sweep_report(points, found).collect()}
    for name in settings:
        if not name.startswith("squared"):
            assert report[name].accuracy == pytest.approx((((x @ found.weights[name]) > 0) == (y == 1)).mean())


def test_penalties_shrink_and_rounds_can_end_early(spark):
    _, _, points = _labelled(spark)
    strong = {"l1": descent.Setting("logistic", "l1", 1.0, 0.4), "l2": descent.Setting("logistic", "l2", 1.0, 0.4), "none": descent.Setting("logistic")}
    found = descent.descend(points, strong, 4, 30)
    length = {m: np.abs(w).sum() for m, w in found.weights.items()}
    assert length["l1"] < length["l2"] < length["none"] and (found.weights["l1"] == 0).any()
    early = descent.descend(points, {"m": descent.Setting("logistic", "l2", 1.0, 1.0)}, 4, 200, tolerance=1e-2)
    assert len(early.losses) < 60
    sampled = descent.descend(points, {"m": descent.Setting("logistic")}, 4, 20, fraction=0.5)
    assert np.sign(sampled.weights["m"][1]) == 1 and np.sign(sampled.weights["m"][2]) == -1
    again = descent.descend(points, {"m": descent.Setting("logistic")}, 4, 2, start={"m": found.weights["none"]})
    assert not np.allclose(again.weights["m"], 0)
    with pytest.raises(ValueError):
        descent.Setting("logistic", "l3")


def test_wide_sparse_online_regression(spark, folder):
    rng = np.random.default_rng(9)
    width, n = 2000, 120
    entries = [sorted(rng.choice(width, 8, replace=False).tolist()) for _ in range(n)]
    values = rng.normal(size=(n, 8))
    labels = values.sum(1)
    data = [(float(b), (e, v.tolist())) for b, e, v in zip(labels, entries, values)]
    points = spark.createDataFrame(data, "label double, features struct<indices array<int>, values array<double>>")
    models = online.OnlineRegression(spark, folder, width, {"a": 0.5, "b": 5.0}, iterations=2)
    models.train_batch(points, 0)
    models.train_batch(points, 1)
    models.train_batch(points, 1)
    models.train_batch(points.filter("label > 1e9"), 2)
    x = np.zeros((n, width))
    for i, (e, v) in enumerate(zip(entries, values)):
        x[i, e] = v
    for name, step in (("a", 0.5), ("b", 5.0)):
        w, errors = np.zeros(width), []
        for _ in range(2):
            errors.append(np.mean((x @ w - labels) ** 2))
            for i in (1, 2):
                w = w - step / np.sqrt(i) / n * (x @ w - labels) @ x
        kept = {r.batch_id: r for r in models.history().filter(F.col("model") == name).collect()}
        assert np.allclose(kept[1].weights, w) and np.allclose([kept[0].mse, kept[1].mse], errors)
        assert np.allclose(kept[2].weights, w) and kept[2].rows == 0 and kept[2].mse is None


@pytest.mark.parametrize("chunk, part", [(10, 4), (64, 64), (1000, 16)])
def test_inner_product_search_equals_brute_force(spark, chunk, part, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_ITEMS", chunk)
    monkeypatch.setattr(search, "PART_ITEMS", part)
    rng = np.random.default_rng(chunk)
    # whole numbers, so that products and ties are exact
    items = rng.integers(-9, 10, (90, 4)) * rng.integers(1, 9, (90, 1))
    items[30:34], items[50] = items[3], 0
    users = np.vstack((rng.integers(-5, 6, (40, 4)), np.zeros((1, 4), int)))
    scores = users @ items.T
    order = [sorted(range(90), key=lambda i: (-s[i], i)) for s in scores]
    best = search.best_items(vectors(spark, users), vectors(spark, items), 7).collect()
    assert sorted((r.user, r["rank"], r.product, r.score) for r in best) == [(u, r + 1, order[u][r], scores[u][order[u][r]]) for u in range(41) for r in range(7)]
    pairs = [(u, int(p)) for u in range(41) for p in rng.choice(90, 20, replace=False)]
    asked = spark.createDataFrame(pairs * 2, "user long, product long")
    ranks = search.item_ranks(vectors(spark, users), vectors(spark, items), asked, parts=3).collect()
    assert sorted((r.user, r.product, r["rank"]) for r in ranks) == sorted((u, p, order[u].index(p) + 1) for u, p in pairs)


def test_whole_ranking_precision_by_hand(spark):
    ranks = spark.createDataFrame([(1, 1), (1, 4), (2, 3), (2, 200)], "user long, rank long")
    whole = dict(rows(search.whole_ranking_precision(ranks), "user", "average_precision"))
    assert whole == {1: (1 + 2 / 4) / 2, 2: (1 / 3 + 2 / 200) / 2}
    assert dict(rows(search.whole_ranking_precision(ranks, 100), "user", "average_precision"))[2] == (1 / 3) / 2


def test_many_ranks_of_one_hot_group(spark):
    rng = random.Random(1)
    data = [("hot", rng.randrange(10**6), i) for i in range(20_000)] + [("cold", i, i) for i in range(30)]
    df = spark.createDataFrame(data, "k string, v long, id long").repartition(9)
    found = top_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 5000, salts=8)
    hot = sorted((x for x in data if x[0] == "hot"), key=lambda x: (-x[1], x[2]))[:5000]
    got = sorted((r["rank"], r.v, r.id) for r in found.filter("k = 'hot'").collect())
    assert got == [(i + 1, v, n) for i, (_, v, n) in enumerate(hot)]
    assert found.filter("k = 'cold'").count() == 30
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("width, spread", [(0.5, 10**7), (1000.0, 10**5), (1e9, 10**6)])
def test_bucketed_median_folds_long_histograms(spark, width, spread):
    rng = random.Random(spread)
    values = [rng.randrange(spread) for _ in range(12_000)] + [5] * 50
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for q in (0.01, 0.5, 1.0):
        assert bucketed_median(df, "v", width, q).first()[0] == sorted(values)[quantile_rank(len(values), q) - 1]
    assert bucketed_median(df.filter("v < 0"), "v", width).first()[0] is None


def test_asked_items_come_in_bounded_rows_of_their_own_number(spark, monkeypatch):
    monkeypatch.setattr(search, "PAIR_ROWS", 8)
    monkeypatch.setattr(search, "CHUNK_ITEMS", 32)
    monkeypatch.setattr(search, "PART_ITEMS", 16)
    states, plain = [], search._search
    monkeypatch.setattr(search, "_search", lambda state, *rest: plain(states.append(state) or state, *rest))
    rng = np.random.default_rng(5)
    items = rng.integers(-4, 5, (90, 3))
    items[20:50] = items[7]  # one group of copies, in several chunks
    users = rng.integers(-5, 6, (3, 3))
    scores = users @ items.T
    order = [sorted(range(90), key=lambda i: (-s[i], i)) for s in scores]
    pairs = [(0, p) for p in range(90)] + [(1, 3), (1, 44), (1, 45)] + [(2, p) for p in range(0, 90, 2)]
    asked = spark.createDataFrame(pairs, "user long, product long")
    ranks = search.item_ranks(vectors(spark, users), vectors(spark, items), asked, parts=3).collect()
    assert sorted((r.user, r.product, r["rank"]) for r in ranks) == sorted((u, p, order[u].index(p) + 1) for u, p in pairs)
    sizes = [(r.user, r.n) for r in states[0].select("user", F.size("products").alias("n")).collect()]
    assert max(n for _, n in sizes) <= 8  # however many one user asks for
    assert [n for u, n in sizes if u == 1] == [3]  # and few of them meet the items once
    assert spark.conf.get(search.ARROW_ROWS) == "10000"


@pytest.mark.parametrize("few, bytes_", [(128, 1 << 30), (0, 1 << 30), (128, 1), (0, 1)])
def test_item_ranks_of_real_vectors_with_copies_equal_brute_force(spark, monkeypatch, few, bytes_):
    monkeypatch.setattr(search, "CHUNK_ITEMS", 40)
    monkeypatch.setattr(search, "PART_ITEMS", 4)
    monkeypatch.setattr(search, "PAIR_ROWS", 7)
    monkeypatch.setattr(search, "FEW", few)
    monkeypatch.setattr(search, "ROUND_BYTES", bytes_)
    stored, plain = [], search.work_path
    monkeypatch.setattr(search, "work_path", lambda s, name: stored.append(name) or plain(s, name))
    rng = np.random.default_rng(7)
    items, users = rng.normal(size=(90, 5)) * rng.uniform(0.1, 9, (90, 1)), rng.normal(size=(6, 5))
    items[40:60], items[70], users[5] = items[3], 0, 0
    items[80:85] = items[3] * (1 + 1e-13 * np.arange(5)[:, None])  # told apart by the last digits only
    scores = [[sum((a * b for a, b in zip(u, i)), 0.0) for i in items] for u in users]
    order = [sorted(range(90), key=lambda i: (-s[i], i)) for s in scores]
    pairs = [(u, int(p)) for u in range(6) for p in (*rng.choice(70, 20, replace=False), 3, 70, 81, 82)]
    asked = spark.createDataFrame(pairs + [(0, 500), (77, 1)], "user long, product long")
    found = search.item_ranks(vectors(spark, users), vectors(spark, items), asked).collect()
    assert sorted((r.user, r.product, r.score, r["rank"]) for r in found) == sorted({(u, p, scores[u][p], order[u].index(p) + 1) for u, p in pairs})
    assert stored.count("search") == (1 if bytes_ > 1 else 6)  # users are written once where all chunks fit a round


def test_asked_pairs_are_dealt_without_vectors(spark, monkeypatch):
    plans, plain = [], search._search
    monkeypatch.setattr(search, "_search", lambda state, *rest: plans.append(state._jdf.queryExecution().optimizedPlan().toString()) or plain(state, *rest))
    users, items = vectors(spark, [[1.0, 2.0]]), vectors(spark, [[1.0, 0.0], [0.0, 1.0]])
    found = search.item_ranks(users, items, spark.createDataFrame([(0, 0), (0, 1)], "user long, product long"))
    assert sorted((r.product, r["rank"]) for r in found.collect()) == [(0, 2), (1, 1)]
    assert "zip_with" not in plans[0]  # a product taken in a join of the pairs


def test_first_places_leave_other_ranks_out_of_the_window(spark):
    ranks = spark.createDataFrame([(1, 1), (1, 4), (2, 30)], "user long, rank long")
    found = search.whole_ranking_precision(ranks, 3)
    assert rows(found, "user", "average_precision", "owned") == [(1, 0.5, 2), (2, 0.0, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 3" in plan[plan.index("Window ") :]


def test_best_items_leave_out_rows_without_a_better_one(spark, monkeypatch):
    monkeypatch.setattr(search, "PART_ITEMS", 4)
    sorted_rows, plain = [], np.lexsort
    monkeypatch.setattr(search.np, "lexsort", lambda keys: plain(sorted_rows.append(len(keys[0])) or keys))
    found = {}
    monkeypatch.setattr(search, "_search", lambda state, items, schema, step: found.update(step=step) or spark.createDataFrame([], schema))
    search.best_items(vectors(spark, [[1.0, 0.0]]), vectors(spark, [[1.0, 0.0]]), 2)
    items = np.array([[9.0, 0.0], [8.0, 0.0]] + [[0.0, 7.0]] * 18)
    lengths = np.full(20, 9.0)  # no part is too short
    state = pa.RecordBatch.from_pydict({"user": [1], "vector": [[1.0, 0.0]], "done": [False], "ids": pa.array([[]], pa.list_(pa.int64())), "scores": pa.array([[]], pa.list_(pa.float64()))})
    (out,) = found["step"](iter([state]), 0, np.arange(20), items, lengths)
    assert out.column("ids").to_pylist() == [[0, 1]] and len(sorted_rows) == 1


def test_counted_slots_equal_a_counter(spark):
    rng = random.Random(3)
    data = [[], [5], [7] * 9, list(range(400, 0, -1))] + [[rng.randrange(20) for _ in range(n)] for n in range(1, 60)]
    df = spark.createDataFrame([(n, x) for n, x in enumerate(data)] + [(-1, None)], "n int, x array<int>")
    got = {r.n: r.f for r in df.select("n", counted_slots("x").alias("f")).collect()}
    for n, x in enumerate(data):
        counts = sorted(Counter(x).items())
        assert (got[n]["indices"], got[n]["values"]) == ([i for i, _ in counts], [float(c) for _, c in counts])
    assert got[-1]["indices"] is None and got[-1]["values"] is None


def test_words_of_a_turn_are_hashed_once(spark, folder):
    spark.createDataFrame([(1, 1, "b a b c " * 30)], "conv_id long, turn int, text string").write.parquet(f"{folder}/conversations.parquet")
    plan = _turns(spark, folder)._jdf.queryExecution().analyzed().toString()
    assert plan.count("md5(") == 1
