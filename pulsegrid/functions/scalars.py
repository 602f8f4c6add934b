"""Scalar expressions; every one is a built-in Spark expression, so it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "byte_length",
    "cents",
    "clean_number",
    "date_parts",
    "epoch_millis",
    "half_up",
    "json_field",
    "meter_time",
    "millis_of_text",
    "minute_of_day",
    "month_label",
    "non_negative",
    "portable_bucket",
    "rank_position",
    "relative_error_pct",
    "series_text",
    "strip_suffix",
    "threshold_label",
    "word_tokens",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(payload: Column | str, key: str, type_name: str = "string") -> Column:
    """One field of a JSON text, cast after rendering, so ``5`` and ``"5"`` are both the number 5.

    Use for one or two fields; for more, parse once with ``from_json``.
    """
    value = F.get_json_object(_col(payload), f"$.{key}")
    return value if type_name == "string" else value.cast(type_name)


def byte_length(c: Column | str) -> Column:
    """Number of UTF-8 bytes as a long."""
    return F.octet_length(_col(c)).cast("long")


def cents(c: Column | str) -> Column:
    """Two-decimal amount as whole cents, which sum exactly in any order."""
    return F.floor(_col(c) * 100 + F.lit(0.5)).cast("long")


def epoch_millis(c: Column | str) -> Column:
    """Milliseconds since 1970 (session zone UTC) of a timestamp with or without zone."""
    return F.unix_millis(_col(c).cast("timestamp"))


def millis_of_text(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.unix_millis(F.to_timestamp(_col(c), pattern))


def meter_time(date: Column | str, time: Column | str) -> Column:
    """Timestamp from ``dd/MM/yyyy`` and 24-hour ``HH:mm:ss``; null when malformed."""
    text = F.concat_ws(" ", _col(date), _col(time))
    return F.try_to_timestamp(text, F.lit("d/M/yyyy H:mm:ss"))


def date_parts(ts: Column | str) -> dict[str, Column]:
    ts = _col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def minute_of_day(ts: Column | str) -> Column:
    ts = _col(ts)
    return F.hour(ts) * 60 + F.minute(ts)


def month_label(ts: Column | str) -> Column:
    """Zero-padded month label, for example ``2007年01月`` (fixed output format)."""
    ts = _col(ts)
    return F.concat(
        F.year(ts).cast("string"), F.lit("年"), F.lpad(F.month(ts).cast("string"), 2, "0"), F.lit("月")
    )


def half_up(c: Column | str, digits: int) -> Column:
    """Decimal rounding for report text; not for values that are compared or summed later."""
    return F.round(_col(c), digits)


def clean_number(c: Column | str) -> Column:
    """Quoted numeric text to double; a missing marker or other text becomes 0."""
    text = F.regexp_replace(_col(c).cast("string"), '"', "")
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def non_negative(c: Column | str) -> Column:
    return F.greatest(_col(c), F.lit(0.0))


def threshold_label(c: Column | str, threshold: float) -> Column:
    return F.when(_col(c) >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def relative_error_pct(predicted: Column | str, actual: Column | str) -> Column:
    """|predicted - actual| / actual * 100; null when the actual value is 0."""
    predicted, actual = _col(predicted), _col(actual)
    return F.when(actual != 0, F.abs(predicted - actual) / actual * 100)


def strip_suffix(c: Column | str, n_chars: int = 24) -> Column:
    """Drop a fixed-length trailing digest from an envelope."""
    c = _col(c)
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - n_chars, F.lit(0)))


def word_tokens(c: Column | str, pattern: str = r"\s+") -> Column:
    """Non-empty tokens of a text."""
    return F.array_remove(F.split(_col(c), pattern), "")


def rank_position(n: Column, q: float) -> Column:
    """1-based rank ``floor((n+1)*q)`` kept inside 1..n."""
    return F.greatest(F.lit(1).cast("long"), F.least(n.cast("long"), F.floor((n + 1) * F.lit(float(q)))))


def portable_bucket(key: Column | str, buckets: int, seed: int = 0) -> Column:
    """Bucket 0..buckets-1 of a key by its digest: same split on any engine and on every retry."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), _col(key).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def series_text(order: Column | str, value: Column | str, sep: str = ",") -> Column:
    """Aggregate: values joined by ``sep`` in the order of ``order`` (short report series only)."""
    pairs = F.sort_array(F.collect_list(F.struct(_col(order).alias("o"), _col(value).cast("string").alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)
