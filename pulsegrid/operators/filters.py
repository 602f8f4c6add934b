"""Conditions, splits and word lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import portable_bucket

Conditions = Mapping[str, object] | Iterable[tuple[str, object]]


def _pairs(conditions: Conditions) -> list[tuple[str, object]]:
    return list(conditions.items()) if isinstance(conditions, Mapping) else list(conditions)


def key_is(key: str, value: object) -> Column:
    """The rendered value of a field equals the text of ``value``.

    A missing field gives null, which a filter, a ``when`` and an OR take as no match; a plain comparison
    reaches the files.
    """
    return F.col(key).cast("string") == F.lit(str(value))


def all_of(conditions: Conditions) -> Column:
    return reduce(lambda a, b: a & b, (key_is(k, v) for k, v in _pairs(conditions)), F.lit(True))


def any_of(conditions: Conditions) -> Column:
    return reduce(lambda a, b: a | b, (key_is(k, v) for k, v in _pairs(conditions)), F.lit(False))


def condition_filter(df: DataFrame, conditions: Conditions) -> DataFrame:
    """Rows that meet every condition, duplicates kept; no condition passes everything."""
    return df.filter(all_of(conditions)) if _pairs(conditions) else df


def and_filter_set(df: DataFrame, conditions: Conditions, payload: str = "payload") -> DataFrame:
    """Distinct payloads of the rows that meet every condition."""
    return condition_filter(df, conditions).select(payload).distinct()


def or_filter(df: DataFrame, conditions: Conditions) -> DataFrame:
    """Rows that meet at least one condition, duplicates kept."""
    return df.filter(any_of(conditions))


def condition_key(conditions: Conditions) -> str:
    """Result key of a report: the condition names in argument order."""
    return "".join(f"{key}_" for key, _ in _pairs(conditions))


def in_years(df: DataFrame, ts: str, years: Iterable[int]) -> Column:
    """Ranges with bounds of the column's own type, so that they reach the files."""
    kind = df.schema[ts].dataType.simpleString()
    start = lambda year: F.lit(f"{year}-01-01 00:00:00").cast(kind)
    ranges = [(F.col(ts) >= start(y)) & (F.col(ts) < start(y + 1)) for y in years]
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def year_split(df: DataFrame, ts: str, train_years: Iterable[int], test_years: Iterable[int]):
    return df.filter(in_years(df, ts, train_years)), df.filter(in_years(df, ts, test_years))


def listed_filter(df: DataFrame, column: str, listed: DataFrame, listed_col: str, keep: str = "listed") -> DataFrame:
    """Rows whose value is (``listed``) or is not (``unlisted``) in a list."""
    if keep not in ("listed", "unlisted"):
        raise ValueError("keep is 'listed' or 'unlisted'")
    words = listed.select(F.col(listed_col).alias("_listed")).distinct()
    how = "left_semi" if keep == "listed" else "left_anti"
    return df.join(words, F.col(column) == F.col("_listed"), how)


def listed_report(df: DataFrame, column: str, listed: DataFrame, listed_col: str) -> DataFrame:
    """Occurrences per value with the list as a flag: kept counts and dropped counts from one pass."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    words = listed.select(F.col(listed_col).alias(column)).distinct().withColumn("dropped", F.lit(True))
    return counts.join(words, column, "left").withColumn("dropped", F.coalesce("dropped", F.lit(False)))


def point_lookup(requests: DataFrame, readings: DataFrame, on: str, value: str) -> DataFrame:
    """Each requested key with its reading: ``missing`` (0), ``one`` or ``duplicated`` (with the count).

    The readings are reduced to the requested keys before they are grouped. The value of a
    duplicated key is its smallest reading, so that a retry gives the same answer.
    """
    wanted = requests.select(on).distinct()
    found = (
        readings.join(wanted, on, "left_semi")
        .groupBy(on)
        .agg(F.count("*").alias("matches"), F.min(value).alias("actual"))
    )
    matches = F.coalesce("matches", F.lit(0).cast("long"))
    return requests.join(found, on, "left").select(
        *requests.columns,
        matches.alias("matches"),
        F.coalesce("actual", F.lit(0.0)).alias("actual"),
        F.when(matches == 0, "missing").when(matches == 1, "one").otherwise("duplicated").alias("outcome"),
    )


def hash_split(df: DataFrame, key: str, weights: Iterable[float], seed: int = 0) -> DataFrame:
    """Adds ``part``: the index of the weighted share a key falls into; the same on every run."""
    weights = list(weights)
    scale = 10_000
    bucket = portable_bucket(key, scale, seed)
    part = F.lit(len(weights) - 1)
    edge = sum(weights)
    for index in range(len(weights) - 2, -1, -1):
        edge = sum(weights[: index + 1]) / sum(weights)
        part = F.when(bucket < int(round(edge * scale)), F.lit(index)).otherwise(part)
    return df.withColumn("part", part)


def k_folds(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """Adds ``fold`` 0..k-1; fold ``i`` is the validation set of round ``i``."""
    return df.withColumn("fold", portable_bucket(key, k, seed))


def fold_pair(folded: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    return folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
