"""Event-time windows.

A sliding window much longer than its slide would copy every row into each window that holds it
(50 copies at 300 s by 6 s). Rows are therefore summed once per pane, the slide-wide tumbling
window. Where windows are read, a pane enters at the first window that holds it and leaves behind the
last: two rows a pane, whatever the window's length, and a window is the running total of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import byte_length, rank_position
from pulsegrid.operators.partitions import row_index
from pulsegrid.operators.rank_select import grouped_rank_select
from pulsegrid.session import written

#: Slides of one block of running totals, a task's share of a key.
BLOCK_SLIDES = 4096
#: Bits of a value's place that one level of a median search settles.
DIGIT_BITS = 10

__all__ = [
    "batch_window_median",
    "event_time",
    "finished_windows",
    "pane_totals",
    "sliding_counts",
    "stream_join",
    "value_counts",
    "window_median",
    "windows_of_panes",
]


def event_time(stream: DataFrame, column: str, delay: str | None = None) -> DataFrame:
    """Zoned event time (watermarks need it) with an optional watermark."""
    typed = stream.withColumn(column, F.col(column).cast("timestamp"))
    return typed.withWatermark(column, delay) if delay else typed


def pane_totals(
    df: DataFrame, ts: str, pane_seconds: int, keys: list[str] | None = None, amount: str | None = None, payload: str | None = None
) -> DataFrame:
    """Count, and optionally amount and bytes, per pane and key (streaming or batch)."""
    measures = [F.count("*").alias("n")]
    if amount:
        measures.append(F.sum(amount).alias("amount"))
    if payload:
        measures.append(F.sum(byte_length(payload)).alias("bytes"))
    panes = df.groupBy(F.window(ts, f"{pane_seconds} seconds").alias("w"), *(keys or [])).agg(*measures)
    return panes.withColumn("pane", F.unix_seconds("w.start")).drop("w")


def windows_of_panes(panes: DataFrame, size_seconds: int, slide_seconds: int, keys: list[str] | None = None) -> DataFrame:
    """Sliding windows ``[window_start, window_start + size)`` aligned to the slide, as sums of panes.

    The pane width must divide the slide. A window appears when at least one of its panes does.
    Measures are whole numbers or decimals, so that what leaves takes away exactly what has entered.
    """
    keys = keys or []
    measures = [c for c in panes.columns if c not in keys and c not in ("pane", "batch_id")]
    if any(isinstance(panes.schema[m].dataType, (T.DoubleType, T.FloatType)) for m in measures):
        raise TypeError("sums of sliding windows need whole numbers or decimals")
    slide, size = F.lit(slide_seconds).cast("long"), F.lit(size_seconds).cast("long")
    last = F.col("pane") - F.pmod(F.col("pane"), slide)
    first = last - F.lit((size_seconds - 1) // slide_seconds * slide_seconds).cast("long")
    first = F.when(first + size > F.col("pane"), first).otherwise(first + slide)
    edges = F.array(F.struct(first.alias("at"), F.lit(1).cast("long").alias("sign")), F.struct((last + slide).alias("at"), F.lit(-1).cast("long").alias("sign")))
    changes = panes.filter(first <= last).select(*keys, *measures, F.inline(edges))
    changes = changes.groupBy(*keys, "at").agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in measures], F.sum("sign").alias("_open"))
    return _between_changes(changes, keys, measures, slide_seconds)


def _between_changes(changes: DataFrame, keys: list[str], measures: list[str], slide_seconds: int) -> DataFrame:
    """Running totals of the changes at every window start with an open pane.

    A key's time is cut into blocks; what earlier blocks add up to is carried into each, so that a
    task holds a block of a key and not all of it.
    """
    sums = [*measures, "_open"]
    block = F.floor(F.col("at") / F.lit(slide_seconds * BLOCK_SLIDES))
    changes = changes.withColumn("_block", block)
    by_key = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_b")  # a row per block
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    blocks = changes.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b")).agg(
        *[F.sum(m).alias(m) for m in sums], F.min("at").alias("_first")
    )
    carried = blocks.select(
        *[f"_k{i}" for i in range(len(keys))], "_b", F.lead("_first").over(by_key).alias("_later"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_c{i}") for i, m in enumerate(sums)],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = changes.join(carried, [F.col("_block") == F.col("_b"), *same])
    within = Window.partitionBy(*keys, "_block").orderBy("at")
    totals = joined.select(
        *keys, "at", F.coalesce(F.lead("at").over(within), F.col("_later")).alias("_next"),
        *[(F.col(f"_c{i}") + F.sum(m).over(within)).alias(m) for i, m in enumerate(sums)],
    )
    slide = F.lit(slide_seconds).cast("long")
    starts = F.sequence("at", F.col("_next") - slide, slide)
    return totals.filter("_open > 0").select(F.explode(starts).alias("window_start"), *keys, *measures)


def finished_windows(
    stream: DataFrame, ts: str, size: str, slide: str | None = None, keys: list[str] | None = None, amount: str | None = None
) -> DataFrame:
    """Native windowed aggregation, for windows only a few slides long."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    measures = [F.count("*").alias("n")] + ([F.sum(amount).alias("amount")] if amount else [])
    grouped = stream.groupBy(window.alias("w"), *(keys or [])).agg(*measures)
    return grouped.withColumn("window_start", F.unix_seconds("w.start")).drop("w")


def sliding_counts(stream: DataFrame, ts: str, size: str, slide: str, value: str | None = None) -> DataFrame:
    """Rows per sliding window, or per window and value."""
    return finished_windows(stream, ts, size, slide, [value] if value else None)


def value_counts(df: DataFrame, ts: str, pane_seconds: int, value: str) -> DataFrame:
    """Rows per pane and distinct value: the state from which any window's exact median follows.

    State is keyed by (pane, value), so a busy window spreads over all tasks.
    """
    return pane_totals(df, ts, pane_seconds, [value])


def window_median(counts: DataFrame, size_seconds: int, slide_seconds: int, value: str, q: float = 0.5) -> DataFrame:
    """Exact order statistic of every sliding window from its (pane, value) counts.

    Values are numbered in order. From the highest bits of the number downwards, the counts per pane
    and digit give every window's counts, and the digit that holds its rank; only values that share
    the digits found for some window go to the next level. What is stored is a row per window.
    """
    counts = counts.filter(F.col(value).isNotNull())
    kind = counts.schema[value].dataType
    whole = isinstance(kind, T.IntegralType)
    if whole:
        lowest, highest = counts.agg(F.min(value), F.max(value)).first()
        numbered = counts.withColumn("_no", F.col(value) - F.lit(lowest))
    else:
        order = written(row_index(counts.select(value).distinct(), [value], "_no"), "values")
        lowest, highest = order.agg(F.min("_no"), F.max("_no")).first()
        numbered = counts.join(order, value)
    numbered = numbered.select("pane", F.col("_no").cast("long").alias("_no"), "n")
    panes = numbered.groupBy("pane").agg(F.sum("n").alias("n"))
    every = windows_of_panes(panes, size_seconds, slide_seconds)
    state = written(every.select("window_start", rank_position(F.col("n"), q).alias("need"), F.lit(0).cast("long").alias("prefix")), "ranks")
    span = 0 if highest is None else int(highest) - int(lowest)
    levels = -(-max(1, span.bit_length()) // DIGIT_BITS)
    for level in reversed(range(levels)):
        shift = level * DIGIT_BITS
        open_ = state.select("prefix").distinct()
        inside = numbered.join(open_, F.shiftright("_no", shift + DIGIT_BITS) == F.col("prefix"), "left_semi")
        cells = inside.groupBy("pane", F.shiftright("_no", shift).alias("cell")).agg(F.sum("n").alias("n"))
        spread = windows_of_panes(cells, size_seconds, slide_seconds, ["cell"]).withColumn("prefix", F.shiftright("cell", DIGIT_BITS))
        by_cell = Window.partitionBy("window_start").orderBy("cell")  # at most 2 ** DIGIT_BITS rows
        upto = spread.join(state, ["window_start", "prefix"]).withColumn("upto", F.sum("n").over(by_cell))
        held = (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))
        state = written(upto.filter(held).select("window_start", (F.col("need") - F.col("upto") + F.col("n")).alias("need"), F.col("cell").alias("prefix")), "ranks")
    if whole:
        return state.select("window_start", (F.col("prefix") + F.lit(lowest)).cast(kind).alias("median"))
    return state.join(order, F.col("prefix") == F.col("_no")).select("window_start", F.col(value).alias("median"))


def batch_window_median(df: DataFrame, ts: str, size: str, value: str, q: float = 0.5) -> DataFrame:
    """Exact order statistic of tumbling windows of a stored table, for windows of any size."""
    placed = df.withColumn("window_start", F.unix_seconds(F.window(F.col(ts).cast("timestamp"), size).start))
    return grouped_rank_select(placed, ["window_start"], value, q, name="median")


def stream_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, delay: str
) -> DataFrame:
    """Inner join of two streams: equal key and right time in ``[left, left + within]``.

    The watermarks and the time bound let Spark drop state that can no longer match.
    """
    a = event_time(left, left_ts, delay).alias("a")
    b = event_time(right, right_ts, delay).alias("b")
    bound = (F.col(f"b.{right_ts}") >= F.col(f"a.{left_ts}")) & (
        F.col(f"b.{right_ts}") <= F.col(f"a.{left_ts}") + F.expr(f"INTERVAL {within}")
    )
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & bound)
