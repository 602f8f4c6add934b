"""Meter queries over order lines and events read as meter readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.functions import threshold_label
from pulsegrid.operators import aggregates as agg
from pulsegrid.operators import power
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import METER, event_readings, meter_readings, table
from pulsegrid.session import work_path
from pulsegrid.sinks import MetricTable, metric_rows, report_json

_MONTH = "year(ts) || '年' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') || '月'"


@query(
    "power_by_month",
    f"WITH {METER} SELECT {_MONTH} AS month, sum(active_kw) / 60 AS active_kwh, sum(reactive_kw) / 60 AS reactive_kwh FROM mt GROUP BY 1",
)
def power_by_month(spark, sf):
    return power.power_by_month(meter_readings(spark, sf))


@query(
    "power_by_day",
    f"""WITH {METER} SELECT CAST(day(ts) AS INTEGER) AS day, sum(active_kw) / 60 AS active_kwh, sum(reactive_kw) / 60 AS reactive_kwh
        FROM mt WHERE year(ts) = 1998 AND month(ts) = 12 GROUP BY 1""",
)
def power_by_day(spark, sf):
    return power.power_by_day(meter_readings(spark, sf), 1998, 12)


_SUMMARY = f"""WITH {METER}, r AS (SELECT active_kw, row_number() OVER (ORDER BY active_kw) AS pos, count(*) OVER () AS c FROM mt)
  SELECT sum(active_kw) / count(*) AS active_mean_kw, sum(reactive_kw) / count(*) AS reactive_mean_kw,
         (SELECT active_kw FROM r WHERE pos = (c + 1) // 2) AS active_median_kw,
         sum(active_kw) / count(*) / 60 AS mean_kwh, sum(active_kw) / 60 AS total_kwh FROM mt"""


@query("power_summary", _SUMMARY)
def power_summary(spark, sf):
    return power.power_summary(meter_readings(spark, sf))


_USAGE = f"""WITH {METER}, u AS (
    SELECT 'kitchen' AS room, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) FILTER (WHERE kitchen <> 0) // 60 AS hours, sum(kitchen) / 1000 AS kwh FROM mt
    UNION ALL SELECT 'laundry', count(DISTINCT CAST(ts AS DATE)), count(*) FILTER (WHERE laundry <> 0) // 60, sum(laundry) / 1000 FROM mt
    UNION ALL SELECT 'bedroom', count(DISTINCT CAST(ts AS DATE)), count(*) FILTER (WHERE bedroom <> 0) // 60, sum(bedroom) / 1000 FROM mt)
  SELECT room, days, hours, kwh, CAST(hours AS DOUBLE) / days AS hours_per_day, kwh / days AS kwh_per_day FROM u"""


@query("appliance_usage", _USAGE)
def appliance_usage(spark, sf):
    return power.appliance_usage(meter_readings(spark, sf))


def _rooms_sql(key, name):
    parts = [f"SELECT {key} AS {name}, '{room}' AS room, sum({room}) / 1000 AS kwh FROM mt GROUP BY 1" for room in power.ROOMS]
    return f"WITH {METER} " + " UNION ALL ".join(parts)


@query("appliance_by_month", _rooms_sql(_MONTH, "month"))
def appliance_by_month(spark, sf):
    return power.appliance_by(meter_readings(spark, sf), "month")


@query("appliance_by_day", _rooms_sql("CAST(day(ts) AS INTEGER)", "day"))
def appliance_by_day(spark, sf):
    return power.appliance_by(meter_readings(spark, sf), "day")


_PROFILE = """er AS (SELECT event_id, ts, floor(value * 100 + 0.5) AS active_kw,
  CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minute FROM events)"""


@query("minute_profile", f"WITH {_PROFILE} SELECT minute, sum(active_kw) / count(*) AS mean, count(*) AS n FROM er GROUP BY 1")
def minute_profile(spark, sf):
    return power.minute_profile(event_readings(spark, sf), "active_kw")


@query(
    "month_series",
    f"""WITH {METER}, m AS (SELECT {_MONTH} AS month, CAST(sum(active_kw) / 60 * 60 AS BIGINT) AS total FROM mt GROUP BY 1)
        SELECT string_agg(month, ',' ORDER BY month) AS months, string_agg(CAST(total AS VARCHAR), ',' ORDER BY month) AS amounts FROM m""",
)
def month_series(spark, sf):
    """Chart texts; the amounts are whole kilowatt-minutes, so that both engines print them alike."""
    from pulsegrid.functions import series_text

    monthly = power.power_by_month(meter_readings(spark, sf))
    return monthly.agg(
        series_text("month", "month").alias("months"),
        series_text("month", F.round(F.col("active_kwh") * 60).cast("long")).alias("amounts"),
    )


@query(
    "confusion_counts",
    """WITH p AS (SELECT l_tax >= 0.04 AS y, l_discount >= 0.05 AS p FROM lineitem)
       SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
              count(*) FILTER (WHERE NOT y AND NOT p) AS tn, count(*) FILTER (WHERE y AND NOT p) AS fn FROM p""",
)
def confusion_counts(spark, sf):
    return agg.confusion(_guesses(spark, sf), "label", "prediction")


def _guesses(spark, sf):
    return table(spark, sf, "lineitem").select(
        threshold_label("l_tax", 0.04).alias("label"), threshold_label("l_discount", 0.05).alias("prediction")
    )


@query(
    "hard_label_metrics",
    """WITH p AS (SELECT l_tax >= 0.04 AS y, l_discount >= 0.05 AS p FROM lineitem),
       c AS (SELECT CAST(count(*) FILTER (WHERE y AND p) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE NOT y AND p) AS DOUBLE) AS fp,
              CAST(count(*) FILTER (WHERE NOT y AND NOT p) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y AND NOT p) AS DOUBLE) AS fn FROM p),
       r AS (SELECT *, tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr, tp / (tp + fp) AS pr, (tp + fn) / (tp + fp + tn + fn) AS base FROM c)
       SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
              (tp + tn) / (tp + fp + tn + fn) AS accuracy, (1 + tpr - fpr) / 2 AS roc_area, tpr * pr + (1 - tpr) * (pr + base) / 2 AS pr_area FROM r""",
)
def hard_label_metrics(spark, sf):
    return agg.hard_label_metrics(_guesses(spark, sf), "label", "prediction")


@query(
    "regression_metrics",
    """SELECT round(avg((l_discount * 100 - l_quantity) * (l_discount * 100 - l_quantity)), 6) AS mse, round(avg(abs(l_discount * 100 - l_quantity)), 6) AS mae,
              round(sqrt(avg(pow(ln(l_discount * 100 + 1) - ln(l_quantity + 1), 2))), 6) AS rmsle FROM lineitem""",
)
def regression_metrics(spark, sf):
    scored = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("label"), (F.col("l_discount") * 100).alias("prediction"))
    found = agg.regression_metrics(scored, "label", "prediction")
    return found.select(*[F.round(c, 6).alias(c) for c in ("mse", "mae", "rmsle")])


def _summary_fields(spark, sf):
    """Summary figures as whole numbers in text, so that both engines print them alike."""
    summary = power.power_summary(meter_readings(spark, sf))
    return metric_rows(
        summary.select(
            F.col("active_median_kw").cast("long").alias("median"), F.round(F.col("total_kwh") * 60).cast("long").alias("total")
        ),
        F.lit("power_1995_2001"),
        {"active_median": "median", "kw_minutes": "total"},
    )


_FIELDS = f"""x AS (SELECT CAST(CAST(active_median_kw AS BIGINT) AS VARCHAR) AS md, CAST(CAST(round(total_kwh * 60) AS BIGINT) AS VARCHAR) AS tt FROM ({_SUMMARY}) s)"""


@query(
    "cached_report",
    f"""WITH {_FIELDS} SELECT 'power_1995_2001' AS result_key, 'report' AS field,
        '[{{"active_median":"' || md || '"}},{{"kw_minutes":"' || tt || '"}}]' AS value FROM x""",
)
def cached_report(spark, sf):
    """A report stored once: a second writer finds the key taken and changes nothing."""
    store = MetricTable(spark, work_path(spark, "cached_report"))
    report = report_json(_summary_fields(spark, sf), "power_1995_2001")
    store.put_once(report, "power", 0)
    store.put_once(report.withColumn("value", F.lit("late")), "power", 1)
    return store.latest("power")


@query(
    "published_metrics",
    f"""WITH {_FIELDS} SELECT 'power_1995_2001' AS result_key, 'active_median' AS field, md AS value FROM x
        UNION ALL SELECT 'power_1995_2001', 'kw_minutes', tt FROM x""",
)
def published_metrics(spark, sf):
    """Figures published on a channel, read back as a subscriber would."""
    store = MetricTable(spark, work_path(spark, "published"))
    store.publish(_summary_fields(spark, sf), "power", 0, channel="power")
    return store.latest(channel="power")


@query(
    "expiring_results",
    "SELECT l_returnflag AS result_key, 'count' AS field, CAST(count(*) AS VARCHAR) AS value FROM lineitem GROUP BY 1",
)
def expiring_results(spark, sf):
    """Results with a lifetime: the expired copy of each field is not seen, the live one is."""
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("count"))
    store = MetricTable(spark, work_path(spark, "expiring"))
    store.put(metric_rows(counts, F.col("l_returnflag"), {"old": "count"}), "ranks", 0, ttl_seconds=-1)
    store.put(metric_rows(counts, F.col("l_returnflag"), {"count": "count"}), "ranks", 1, ttl_seconds=86_400)
    return store.latest("ranks")
