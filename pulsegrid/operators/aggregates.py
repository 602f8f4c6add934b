"""Counts, sums, byte totals, statistics and report panels."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import byte_length
from pulsegrid.operators.filters import Conditions, condition_filter, key_is
from pulsegrid.operators.rank_select import rank_select


def message_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def message_bytes(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.agg(F.coalesce(F.sum(byte_length(payload)), F.lit(0)).cast("long").alias("bytes"))


def count_where(df: DataFrame, key: str, value: object) -> DataFrame:
    return message_count(df.filter(key_is(key, value)))


def bytes_where(df: DataFrame, key: str, value: object, payload: str = "payload") -> DataFrame:
    return message_bytes(df.filter(key_is(key, value)), payload)


def and_count(df: DataFrame, conditions: Conditions) -> DataFrame:
    return message_count(condition_filter(df, conditions))


def field_sum(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias("total"))


def field_avg(df: DataFrame, column: str) -> DataFrame:
    """Sum over the number of rows (not of non-null values)."""
    return df.agg((F.sum(column) / F.count("*")).alias("average"))


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def sum_by(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(column).alias("total"))


def avg_sum_by(df: DataFrame, key: str, column: str) -> DataFrame:
    """Sum, average and whole-number average (``total div n``) per key."""
    return df.groupBy(key).agg(
        F.sum(column).alias("total"),
        (F.sum(column) / F.count("*")).alias("average"),
        F.expr(f"sum({column}) div count(*)").alias("int_average"),
    )


def fold_summary(df: DataFrame, column: str) -> DataFrame:
    """Sum, count, minimum and maximum from one reduction."""
    return df.agg(
        F.sum(column).alias("total"), F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
    )


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(F.countDistinct(*columns).alias("n_distinct"))


def approx_distinct_count(df: DataFrame, column: str, rsd: float = 0.02) -> DataFrame:
    return df.agg(F.approx_count_distinct(column, rsd).alias("n_distinct"))


def kpi_panel(df: DataFrame, amount: str, payload: str = "payload", hold: bool = False) -> DataFrame:
    """Count, total, median, average and bytes in one row.

    The median needs a few passes over the amounts. Set ``hold`` where a row is costly to make (parsed
    from text): amounts and byte counts are then made once and kept for the passes.
    """
    figures = df.select(F.col(amount), byte_length(payload).alias("bytes"))
    if hold:
        figures = figures.persist()
    try:
        median = rank_select(figures, amount, [0.5])[0]
        panel = figures.agg(
            F.count("*").alias("n"),
            F.sum(amount).alias("total"),
            F.lit(median).cast(df.schema[amount].dataType).alias("median"),
            (F.sum(amount) / F.count("*")).alias("average"),
            F.sum("bytes").alias("bytes"),
        )
        # a held panel is read now, as its rows are about to be released
        return df.sparkSession.createDataFrame([tuple(panel.first())], panel.schema) if hold else panel
    finally:
        if hold:
            figures.unpersist()


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample variance, extremes and non-zero count: one row per column, one pass."""
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg(c).alias("mean"),
            F.var_samp(c).alias("variance"),
            F.min(c).cast("double").alias("low"),
            F.max(c).cast("double").alias("high"),
            F.count_if(F.col(c) != 0).alias("nonzeros"),
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("s")).select(F.inline("s"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("correlation"))


def confusion(df: DataFrame, label: str, prediction: str, keys: list[str] | None = None) -> DataFrame:
    """Counts of the four outcomes of a 0/1 prediction, for all rows or per key."""
    return df.groupBy(*(keys or [])).agg(*_outcomes(label, prediction))


def _outcomes(label: str, prediction: str) -> list[Column]:
    positive, said = F.col(label) == 1, F.col(prediction) == 1
    return [
        F.count_if(positive & said).alias("tp"),
        F.count_if(~positive & said).alias("fp"),
        F.count_if(~positive & ~said).alias("tn"),
        F.count_if(positive & ~said).alias("fn"),
    ]


def _by_model(df: DataFrame, predictions: Mapping[str, str], figures: Callable[[str], list[Column]]) -> DataFrame:
    """One row of aggregates per model, whose prediction is a column of its own: one pass for all."""
    per_model = [F.struct(F.lit(name).alias("model"), *figures(column)) for name, column in predictions.items()]
    return df.agg(F.array(*per_model).alias("m")).select(F.inline("m"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def hard_label_metrics(df: DataFrame, label: str, prediction: str, keys: list[str] | None = None) -> DataFrame:
    """Accuracy and the areas under the ROC and precision-recall curves of a hard 0/1 prediction.

    A hard prediction gives a curve with one inner point, so both areas have a closed form.
    """
    return _hard_label_figures(confusion(df, label, prediction, keys), keys or [])


def hard_label_metrics_by_model(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """:func:`hard_label_metrics` of several models (``predictions`` maps a model to its column) from one pass."""
    return _hard_label_figures(_by_model(df, predictions, lambda column: _outcomes(label, column)), ["model"])


def _hard_label_figures(c: DataFrame, keys: list[str]) -> DataFrame:
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    tpr, fpr = _ratio(tp, tp + fn), _ratio(fp, fp + tn)
    precision, base = _ratio(tp, tp + fp), _ratio(tp + fn, n)
    return c.select(
        *keys,
        "tp",
        "fp",
        "tn",
        "fn",
        _ratio(tp + tn, n).alias("accuracy"),
        ((1 + tpr - fpr) / 2).alias("roc_area"),
        (tpr * precision + (1 - tpr) * (precision + base) / 2).alias("pr_area"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MSE, MAE and RMSLE; RMSLE is over log(x + 1)."""
    return df.agg(*_errors(label, prediction))


def regression_metrics_by_model(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """:func:`regression_metrics` of several models (``predictions`` maps a model to its column) from one pass."""
    return _by_model(df, predictions, lambda column: _errors(label, column))


def _errors(label: str, prediction: str) -> list[Column]:
    error = F.col(prediction) - F.col(label)
    log_error = F.log(F.col(prediction) + 1) - F.log(F.col(label) + 1)
    return [
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(log_error * log_error)).alias("rmsle"),
    ]


def purchase_report(df: DataFrame, user: str, product: str, price: str) -> DataFrame:
    """Purchases, distinct buyers, revenue and the most bought product (ties: the smallest).

    Rows are reduced per product, and buyers per user, before anything meets in one task.
    """
    by_product = df.groupBy(F.col(product).alias("product")).agg(F.count("*").alias("n"), F.sum(price).alias("revenue"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "product"))
    totals = by_product.agg(F.sum("n").alias("purchases"), F.sum("revenue").alias("revenue"), best.alias("best"))
    totals = totals.select(
        "purchases", "revenue", F.col("best.product").alias("top_product"), (-F.col("best.less")).alias("top_times")
    )
    buyers = df.agg(F.countDistinct(user).alias("buyers"))
    both = totals.unionByName(buyers, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("purchases", "buyers", "revenue", "top_product", "top_times")])
