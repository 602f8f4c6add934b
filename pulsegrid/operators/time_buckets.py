"""Zero-filled time distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import byte_length, epoch_millis
from pulsegrid.operators.filters import Conditions, condition_filter, condition_key
from pulsegrid.sources.keyrange import time_range


def bucket_bounds(start_ms: int, end_ms: int, nodes: int, anchor: str = "start") -> tuple[int, int, int]:
    """(first instant, end instant, width): the width is a whole number of ms, the rest is left over
    at the end (``anchor='start'``) or at the beginning (``anchor='end'``)."""
    width = (end_ms - start_ms) // nodes
    if width <= 0:
        raise ValueError("the time span must hold at least one millisecond per bucket")
    if anchor == "start":
        return start_ms, start_ms + width * nodes, width
    if anchor == "end":
        return end_ms - width * nodes, end_ms, width
    raise ValueError("anchor is 'start' or 'end'")


def time_distribution(
    df: DataFrame,
    time_col: str,
    start_ms: int,
    end_ms: int,
    nodes: int,
    measure: str | None = None,
    anchor: str = "start",
) -> DataFrame:
    """Count (or the sum of ``measure``) per bucket: ``pos`` 1..nodes, ``bucket_end``, ``amount``.

    ``time_col`` is epoch ms or a timestamp; the span is compared in the column's own type, so it
    reaches the files. Buckets are half open. Rows outside the buckets count nowhere; empty
    buckets are 0.
    """
    first, last, width = bucket_bounds(start_ms, end_ms, nodes, anchor)
    inside = df.filter(time_range(df, time_col, first, last))
    total = F.count("*") if measure is None else F.sum(measure)
    counted = inside.groupBy(bucket_position(df, time_col, first, width).alias("pos")).agg(total.alias("amount"))
    return fill_buckets(counted, first, width, nodes)


def bucket_position(df: DataFrame, time_col: str, first: int, width: int) -> Column:
    """1-based bucket of a time."""
    if isinstance(df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        at = epoch_millis(time_col)
    else:
        at = F.col(time_col)
    return F.floor((at - F.lit(first)) / F.lit(width)).cast("long") + F.lit(1).cast("long")


def distribution_report(
    df: DataFrame,
    time_col: str,
    conditions: Conditions,
    start_ms: int,
    end_ms: int,
    nodes: int,
    measure: str | None = None,
    payload: str = "payload",
) -> DataFrame:
    """Bytes, total count (or amount) and zero-filled distribution of the rows that meet the
    conditions, as (result_key, field, value) rows keyed by the condition names.

    One scan: rows are summed per bucket, and the whole report is read from that table of at most
    ``nodes + 1`` rows. The rest after the last bucket counts in the totals only.
    """
    first, _, width = bucket_bounds(start_ms, end_ms, nodes)
    key, name = condition_key(conditions), "count" if measure is None else "amount"
    found = condition_filter(df, conditions).filter(time_range(df, time_col, start_ms, end_ms))
    total = F.count("*") if measure is None else F.sum(measure)
    per_bucket = found.groupBy(bucket_position(df, time_col, first, width).alias("pos")).agg(
        total.alias("amount"), F.sum(byte_length(payload)).alias("bytes")
    )
    summed = per_bucket.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"),
        F.map_from_entries(F.collect_list(F.struct("pos", "amount"))).alias("by_pos"),
    )

    def line(result: str, field: Column, value: Column) -> Column:
        return F.struct(
            F.lit(f"{key}_{result}").alias("result_key"), field.alias("field"), value.cast("string").alias("value")
        )

    positions = F.sequence(F.lit(1).cast("long"), F.lit(nodes).cast("long"))
    buckets = F.transform(
        positions,
        lambda p: line(
            f"distribution_{name}",
            (F.lit(first).cast("long") + p * F.lit(width).cast("long")).cast("string"),
            F.coalesce(F.try_element_at("by_pos", p), F.lit(0)),
        ),
    )
    totals = F.array(line("bytesNum", F.lit("value"), F.col("bytes")), line(name, F.lit("value"), F.col("amount")))
    return summed.select(F.inline(F.concat(totals, buckets)))


def fill_buckets(counted: DataFrame, first: int, width: int, nodes: int) -> DataFrame:
    """Complete a (pos, amount) table to 1..nodes and label each bucket with its end."""
    spine = counted.sparkSession.range(1, nodes + 1).withColumnRenamed("id", "pos")
    kind = counted.schema["amount"].dataType
    # at most one row per bucket
    return spine.join(F.broadcast(counted), "pos", "left").select(
        "pos",
        (F.lit(first).cast("long") + F.col("pos") * F.lit(width).cast("long")).alias("bucket_end"),
        F.coalesce("amount", F.lit(0).cast(kind)).alias("amount"),
    )
