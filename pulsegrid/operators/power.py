"""Household meter analysis: minute readings to power summaries and appliance usage.

Readings have ``ts`` and the measures of ``METER_MEASURES`` (kW for power, Wh for sub-meters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import minute_of_day, month_label, series_text
from pulsegrid.operators.rank_select import rank_select, lower_middle_rank

ROOMS = ["kitchen", "laundry", "bedroom"]


def between_times(readings: DataFrame, start: str, end: str) -> DataFrame:
    """Readings from ``start`` to ``end``, both included; the bounds reach the files."""
    kind = readings.schema["ts"].dataType.simpleString()
    return readings.filter(F.col("ts").between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def power_by_month(readings: DataFrame) -> DataFrame:
    """kWh per month: a minute at 1 kW is 1/60 kWh."""
    by_month = readings.groupBy(_month_number().alias("_m")).agg(
        (F.sum("active_kw") / 60).alias("active_kwh"), (F.sum("reactive_kw") / 60).alias("reactive_kwh")
    )
    return by_month.select(_label_of("_m").alias("month"), "active_kwh", "reactive_kwh")


def _month_number():
    """Months since year 0, a number to group by; the label is made of it once per month."""
    return F.year("ts") * 12 + F.month("ts") - 1


def _label_of(number: str):
    return month_label(F.make_date(F.floor(F.col(number) / 12).cast("int"), F.pmod(F.col(number), F.lit(12)) + 1, F.lit(1)))


def power_by_day(readings: DataFrame, year: int, month: int) -> DataFrame:
    """kWh per day of one month."""
    start = f"{year:04d}-{month:02d}-01 00:00:00"
    after = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01 00:00:00"
    kind = readings.schema["ts"].dataType.simpleString()
    inside = readings.filter((F.col("ts") >= F.lit(start).cast(kind)) & (F.col("ts") < F.lit(after).cast(kind)))
    return inside.groupBy(F.dayofmonth("ts").alias("day")).agg(
        (F.sum("active_kw") / 60).alias("active_kwh"), (F.sum("reactive_kw") / 60).alias("reactive_kwh")
    )


def power_summary(readings: DataFrame) -> DataFrame:
    """Mean active and reactive power, median active power, mean and total kWh."""
    median = rank_select(readings, "active_kw", [0.5], rank_rule=lower_middle_rank)[0]
    return readings.agg(
        (F.sum("active_kw") / F.count("*")).alias("active_mean_kw"),
        (F.sum("reactive_kw") / F.count("*")).alias("reactive_mean_kw"),
        F.lit(median).cast("double").alias("active_median_kw"),
        (F.sum("active_kw") / F.count("*") / 60).alias("mean_kwh"),
        (F.sum("active_kw") / 60).alias("total_kwh"),
    )


def appliance_usage(readings: DataFrame) -> DataFrame:
    """Per room: hours in use (whole hours of non-zero minutes), energy in kWh, and both per day.

    Readings are first reduced to one row per day, which also gives the number of days.
    """
    daily = readings.groupBy(F.to_date("ts").alias("day")).agg(
        *[F.count_if(F.col(r) != 0).alias(f"{r}_minutes") for r in ROOMS], *[F.sum(r).alias(f"{r}_wh") for r in ROOMS]
    )
    totals = daily.agg(
        F.count("*").alias("days"),
        *[F.sum(f"{r}_minutes").alias(f"{r}_minutes") for r in ROOMS],
        *[F.sum(f"{r}_wh").alias(f"{r}_wh") for r in ROOMS],
    )
    rooms = F.array(
        *[F.struct(F.lit(r).alias("room"), F.col(f"{r}_minutes").alias("m"), F.col(f"{r}_wh").alias("wh")) for r in ROOMS]
    )
    hours = F.expr("r.m div 60")
    return totals.select("days", F.explode(rooms).alias("r")).select(
        F.col("r.room").alias("room"),
        "days",
        hours.alias("hours"),
        (F.col("r.wh") / 1000).alias("kwh"),
        (hours / F.col("days")).alias("hours_per_day"),
        (F.col("r.wh") / 1000 / F.col("days")).alias("kwh_per_day"),
    )


def appliance_by(readings: DataFrame, period: str) -> DataFrame:
    """Energy per room and ``month`` (label) or ``day`` (day of month): summed wide, then unpivoted."""
    key = _month_number() if period == "month" else F.dayofmonth("ts")
    wide = readings.groupBy(key.alias("_m")).agg(*[(F.sum(r) / 1000).alias(r) for r in ROOMS])
    label = _label_of("_m") if period == "month" else F.col("_m")
    return wide.select(label.alias(period), *ROOMS).unpivot([period], ROOMS, "room", "kwh")


def minute_profile(readings: DataFrame, value: str) -> DataFrame:
    """Mean of a measure per minute of the day (at most 1440 rows)."""
    return readings.groupBy(minute_of_day("ts").alias("minute")).agg(
        (F.sum(value) / F.count("*")).alias("mean"), F.count("*").alias("n")
    )


def month_series(by_month: DataFrame, value: str, digits: int = 2) -> DataFrame:
    """Months and rounded values as two comma-joined texts for a chart."""
    return by_month.agg(
        series_text("month", "month").alias("months"),
        series_text("month", F.round(value, digits)).alias("amounts"),
    )
