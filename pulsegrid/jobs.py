"""Whole reports: a time-key range of stored messages in, result rows in a metric table out.

Each job scans once per question it asks, stores its figures under a key built from its
parameters, and gives the rows it stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import half_up, series_text
from pulsegrid.operators import aggregates as agg
from pulsegrid.operators import power, ranking
from pulsegrid.operators.filters import Conditions, condition_key
from pulsegrid.operators.time_buckets import distribution_report, time_distribution
from pulsegrid.schema import MESSAGE
from pulsegrid.sinks import MetricTable, metric_rows, report_json
from pulsegrid.sources import parse_messages, scan_cells

RESULT_TTL_SECONDS = 60


def stored_messages(
    spark: SparkSession, cells: str, start_ms: int, stop_ms: int, schema: T.StructType = MESSAGE
) -> DataFrame:
    """Messages of a key range with their raw text and the arrival key as ``saleTime`` where they carry none."""
    found = scan_cells(spark, cells, start_ms, stop_ms, family="cf")
    parsed = parse_messages(found.select("row_key", F.col("value").alias("payload")), schema)
    return parsed.withColumn("saleTime", F.coalesce("saleTime", "row_key")).drop("row_key")


def _with_decimal_average(panel: DataFrame) -> DataFrame:
    """The average with six decimals, whose text does not depend on the engine that prints it."""
    return panel.withColumn("average", F.col("average").cast("decimal(38,6)"))


def total_report(messages: DataFrame, store: MetricTable, run: int, amount: str = "price") -> DataFrame:
    """Count, total, median, average and bytes under ``total``."""
    panel = _with_decimal_average(agg.kpi_panel(messages, amount, hold=True))
    fields = {"count": "n", "amount": "total", "median": "median", "average": "average", "bytes": "bytes"}
    store.put(metric_rows(panel, F.lit("total"), fields), "total_report", run)
    return store.latest("total_report")


def distribution_job(
    messages: DataFrame,
    store: MetricTable,
    run: int,
    conditions: Conditions,
    start_ms: int,
    end_ms: int,
    nodes: int,
    measure: str | None = None,
    ttl_seconds: int = RESULT_TTL_SECONDS,
) -> DataFrame:
    """Filtered bytes, count or amount, and zero-filled time distribution; the results expire."""
    report = distribution_report(messages, "saleTime", conditions, start_ms, end_ms, nodes, measure)
    store.put(report, "distribution", run, ttl_seconds)
    return store.latest("distribution")


def rank_job(
    messages: DataFrame,
    store: MetricTable,
    run: int,
    key: str,
    target: str,
    conditions: Conditions = (),
    top: int = 10,
    ttl_seconds: int = RESULT_TTL_SECONDS,
) -> DataFrame:
    """First ``top`` keys by count and by amount under ``<conditions>_<key>_rank``; the results expire."""
    report = ranking.rank_report(messages, key, target, conditions, top)
    name = f"{condition_key(conditions)}{key}_rank_"
    rows = metric_rows(report, F.concat(F.lit(name), "ranking"), field=F.col("key"), value=F.col("score"))
    store.put(rows, "rank", run, ttl_seconds)
    return store.latest("rank")


def and_count_job(
    messages: DataFrame, store: MetricTable, run: int, conditions: Conditions, ttl_seconds: int = RESULT_TTL_SECONDS
) -> DataFrame:
    """Number of messages that meet all conditions."""
    counted = agg.and_count(messages, conditions)
    rows = metric_rows(counted, F.lit(f"{condition_key(conditions)}and"), {"count": "n"})
    store.put(rows, "and_count", run, ttl_seconds)
    return store.latest("and_count")


def refresh_kpis(messages: DataFrame, store: MetricTable, run: int, key: str = "SID", amount: str = "price") -> DataFrame:
    """All figures of the dashboard from a full rescan: the panel, and count and sum per key."""
    panel = metric_rows(
        _with_decimal_average(agg.kpi_panel(messages, amount, hold=True)),
        F.lit("kpi"),
        {"count": "n", "amount": "total", "median": "median", "average": "average", "bytes": "bytes"},
    )
    per_key = messages.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    cells = F.array(
        F.struct(F.lit("count_by_key").alias("result_key"), F.col("key").alias("field"), F.col("n").cast("string").alias("value")),
        F.struct(F.lit("sum_by_key").alias("result_key"), F.col("key").alias("field"), F.col("total").cast("string").alias("value")),
    )
    store.put(panel.unionByName(per_key.select(F.inline(cells))), "kpi", run)
    return store.latest("kpi")


def year_distribution(messages: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Twelve equal parts of a year."""
    return time_distribution(messages, "saleTime", start_ms, end_ms, 12)


def _text(c: Column | str, digits: int) -> Column:
    return half_up(c, digits).cast("string")


def power_report(readings: DataFrame, store: MetricTable, run: int, start: str, end: str, channel: str = "power") -> DataFrame:
    """Summary and monthly series of the readings between two times: published, and kept once per period."""
    inside = power.between_times(readings, start, end)
    summary = power.power_summary(inside)
    figures = {
        "active_mean_kw": "active_mean_kw",
        "active_median_kw": "active_median_kw",
        "reactive_mean_kw": "reactive_mean_kw",
        "mean_kwh": "mean_kwh",
        "total_kwh": "total_kwh",
    }
    rounded = summary.select(*[_text(c, 3).alias(c) for c in figures])
    key = F.lit(f"power_{start}_{end}")
    monthly = power.power_by_month(inside)
    series = power.month_series(monthly, "active_kwh").withColumnRenamed("amounts", "actives")
    rows = metric_rows(rounded, key, figures).unionByName(
        metric_rows(series, key, {"months": "months", "actives": "actives"})
    )
    return _publish_and_keep(rows, store, run, channel, f"power_{start}_{end}")


def appliance_report(readings: DataFrame, store: MetricTable, run: int, start: str, end: str, channel: str = "appliance") -> DataFrame:
    """Usage per room between two times, and its energy by month: published, and kept once per period."""
    inside = power.between_times(readings, start, end)
    usage = power.appliance_usage(inside)
    figures = F.array(
        F.struct(F.lit("hours").alias("name"), F.col("hours").cast("string").alias("value")),
        F.struct(F.lit("hours_per_day").alias("name"), _text("hours_per_day", 2).alias("value")),
        F.struct(F.lit("kwh").alias("name"), _text("kwh", 3).alias("value")),
        F.struct(F.lit("kwh_per_day").alias("name"), _text("kwh_per_day", 2).alias("value")),
    )
    flat = usage.select("room", F.inline(figures))
    rows = metric_rows(
        flat, F.lit(f"appliance_{start}_{end}"), field=F.concat_ws("_", "room", "name"), value=F.col("value")
    )
    return _publish_and_keep(rows.unionByName(_room_series(inside, start, end)), store, run, channel, f"appliance_{start}_{end}")


def _room_series(inside: DataFrame, start: str, end: str) -> DataFrame:
    """Months and energy of each room as two texts."""
    monthly = power.appliance_by(inside, "month")
    texts = monthly.groupBy("room").agg(
        series_text("month", "month").alias("months"), series_text("month", F.round("kwh", 3)).alias("month_kwh")
    )
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("months", "month_kwh")])
    flat = texts.select("room", F.inline(cells))
    return metric_rows(flat, F.lit(f"appliance_{start}_{end}"), field=F.concat_ws("_", "room", "name"), value=F.col("value"))


def model_report(metrics: DataFrame, store: MetricTable, run: int, key: str, channel: str = "models") -> DataFrame:
    """Figures of each model (a row of ``metrics`` with a ``model`` column): published, and kept once per key."""
    names = [c for c in metrics.columns if c != "model"]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("decimal(38,6)").cast("string").alias("value")) for c in names])
    flat = metrics.select("model", F.inline(cells))
    rows = metric_rows(flat, F.lit(key), field=F.concat_ws("_", "model", "name"), value=F.col("value"))
    return _publish_and_keep(rows, store, run, channel, key)


def _publish_and_keep(rows: DataFrame, store: MetricTable, run: int, channel: str, key: str) -> DataFrame:
    store.publish(rows, channel, run, channel)
    published = store.rows().filter((F.col("query") == channel) & (F.col("batch_id") == run))
    store.put_once(report_json(published, key), f"{channel}_reports", run)
    return store.latest(channel=channel)
