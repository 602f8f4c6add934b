"""Classification and regression: fit, evaluate, hold out, sweep, predict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import minute_of_day, relative_error_pct, threshold_label
from pulsegrid.operators.aggregates import (
    hard_label_metrics,
    hard_label_metrics_by_model,
    regression_metrics,
    regression_metrics_by_model,
)
from pulsegrid.operators.power import minute_profile

CLASSIFIERS = {
    "logistic": LogisticRegression,
    "svm": LinearSVC,
    "bayes": NaiveBayes,
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
}
REGRESSORS = {"linear": LinearRegression, "tree": DecisionTreeRegressor}
_TREES = ("tree", "forest")


def estimator(kind: str, name: str, **params):
    family = CLASSIFIERS if kind == "classify" else REGRESSORS
    return family[name](featuresCol="features", labelCol="label", **params)


def metrics_of(kind: str, scored: DataFrame) -> DataFrame:
    if kind == "classify":
        return hard_label_metrics(scored, "label", "prediction").select("accuracy", "pr_area", "roc_area")
    return regression_metrics(scored, "label", "prediction")


def score_areas(scored: DataFrame, score: str = "rawPrediction") -> dict[str, float]:
    """Areas from continuous scores, for models that give them; rows are scored once."""
    kept = scored.select("label", score).persist()
    try:
        return {
            name: BinaryClassificationEvaluator(rawPredictionCol=score, labelCol="label", metricName=metric).evaluate(kept)
            for name, metric in (("roc_area", "areaUnderROC"), ("pr_area", "areaUnderPR"))
        }
    finally:
        kept.unpersist()


def evaluate_all(kind: str, train: DataFrame, test: DataFrame, models: Mapping[str, Mapping]) -> DataFrame:
    """One row of metrics per model; ``models`` maps a result name to (``model``, parameters).

    The training rows are kept on disk while the models learn, since each model keeps a form of them in memory, where
    they would be held twice; the test rows are read once, by all models together.
    """
    train.persist(StorageLevel.DISK_ONLY)
    try:
        fitted = _fitted(kind, train, models)
        if test is not train:
            train.unpersist()
        found = _judged(kind, fitted, test).collect()
    finally:
        train.unpersist()
    cells = [F.struct(*[F.lit(v).cast("string" if c == "model" else "double").alias(c) for c, v in r.asDict().items()]) for r in found]
    return train.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))


def _fitted(kind: str, train: DataFrame, models: Mapping[str, Mapping]) -> dict[str, Model]:
    """All models, learnt in two lanes side by side, so that the tasks of one fill the pauses of the other.

    Tree models keep a point per row and the others a block of rows each: one model of a kind at a time bounds memory.
    """
    if len(models) > 1:
        train.count()  # lanes that start on rows not yet kept would compute them twice

    def learn(names: list[str]) -> dict[str, Model]:
        specs = {name: dict(models[name]) for name in names}
        return {name: estimator(kind, spec.pop("model", name), **spec).fit(train) for name, spec in specs.items()}

    trees = [name for name, spec in models.items() if spec.get("model", name) in _TREES]
    lanes = [lane for lane in ([name for name in models if name not in trees], trees) if lane]
    with ThreadPool(len(lanes)) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(learn), lanes, chunksize=1)
    learnt = {name: model for lane in found for name, model in lane.items()}
    return {name: learnt[name] for name in models}


def _judged(kind: str, fitted: Mapping[str, Model], test: DataFrame) -> DataFrame:
    """Metrics of all models from one pass over the test rows."""
    scored, predictions = test, {name: f"_prediction_{i}" for i, name in enumerate(fitted)}
    for name, column in predictions.items():
        scored = fitted[name].transform(scored).withColumnRenamed("prediction", column).drop("rawPrediction", "probability")
    if kind == "classify":
        return hard_label_metrics_by_model(scored, "label", predictions).select("model", "accuracy", "pr_area", "roc_area")
    return regression_metrics_by_model(scored, "label", predictions)


def sweep(kind: str, train: DataFrame, test: DataFrame, model: str, grid: Iterable[Mapping]) -> DataFrame:
    """Metrics of one model for each parameter setting."""
    named = {",".join(f"{k}={v}" for k, v in g.items()): {"model": model, **g} for g in grid}
    return evaluate_all(kind, train, test, named).withColumnRenamed("model", "parameters")


def log_label_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Regression metrics of a model of log(label), taken back to the original scale."""
    back = scored.select(F.exp(label).alias("label"), F.exp(prediction).alias("prediction"))
    return regression_metrics(back, "label", "prediction")


def minute_predictions(train: DataFrame, test: DataFrame, value: str) -> DataFrame:
    """Predict a measure by its mean at the same minute of the day; the profile has at most 1440 rows.
    A minute not seen in training predicts the mean of all training rows."""
    profile = minute_profile(train, value).select("minute", F.col("mean").alias("prediction"))
    overall = train.agg(F.sum(value) / F.count("*")).first()[0]
    keyed = test.withColumn("minute", minute_of_day("ts"))
    joined = keyed.join(F.broadcast(profile), "minute", "left").withColumn("label", F.col(value))
    return joined.withColumn("prediction", F.coalesce("prediction", F.lit(overall).cast("double")))


def with_error(predicted: DataFrame, prediction: str = "prediction", actual: str = "actual") -> DataFrame:
    return predicted.withColumn("error_pct", relative_error_pct(prediction, actual))


def predict_at(features_model, fitted, requests: DataFrame) -> DataFrame:
    """Model answer and error for requested times that already carry ``actual`` and ``outcome``."""
    scored = fitted.transform(features_model.transform(requests))
    return with_error(scored)


def classify_at(features_model, fitted, requests: DataFrame, threshold: float) -> DataFrame:
    """Class that a model gives requested times which carry ``actual``, beside the class of the actual reading."""
    scored = fitted.transform(features_model.transform(requests))
    return scored.withColumn("actual_label", threshold_label("actual", threshold))
