"""Result table: (result_key, field) -> value, with batches, expiry and channels.

Each query writes a batch table of its own (see :mod:`pulsegrid.sinks.batch_table`): writing a batch
twice changes nothing, and readers open one snapshot and the few batches after it, however long the
table has been written. Readers take the latest row of each field, or the sum of increments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.session import folder_names
from pulsegrid.sinks.batch_table import BatchTable

__all__ = ["MetricTable", "metric_rows", "report_json"]

_COLUMNS = "result_key string, field string, value string, updated_at timestamp, expires_at timestamp, channel string"


def metric_rows(df: DataFrame, key, fields: dict[str, str] | None = None, field=None, value=None) -> DataFrame:
    """(result_key, field, value) rows: either one per named column, or one per row by expressions."""
    if fields is not None:
        cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("value")) for f, c in fields.items()])
        return df.select(key.cast("string").alias("result_key"), F.inline(cells))
    return df.select(
        key.cast("string").alias("result_key"), field.cast("string").alias("field"), value.cast("string").alias("value")
    )


def report_json(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """A report of (field, value) rows as one JSON array of one-entry objects, under ``key``.

    For finished reports, whose number of rows is the number of KPIs.
    """
    # maps do not sort, so the position is kept beside each entry and sorted with it
    entry = F.struct(F.col(order or "field").alias("o"), F.to_json(F.create_map("field", "value")).alias("m"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["m"]), ",")
    return df.agg(F.concat(F.lit("["), joined, F.lit("]")).alias("value")).select(
        F.lit(key).alias("result_key"), F.lit("report").alias("field"), "value"
    )


def _newest_alive(rows: DataFrame) -> DataFrame:
    """Newest row per field and channel; a field whose only row has expired is gone for good."""
    newest = F.max(F.struct("batch_id", "updated_at", "value", "expires_at")).alias("r")
    kept = rows.groupBy("result_key", "field", "channel").agg(newest)
    channels = F.count("*").over(Window.partitionBy("result_key", "field"))
    gone = F.coalesce(F.col("r.expires_at") <= F.current_timestamp(), F.lit(False))
    return kept.withColumn("channels", channels).filter(~gone | (F.col("channels") > 1)).select("result_key", "field", "channel", "r.*")


def _added_up(rows: DataFrame) -> DataFrame:
    """Increments of a field as one row."""
    total = F.sum(F.col("value").cast("long")).cast("string").alias("value")
    other = [F.max(c).alias(c) for c in ("updated_at", "expires_at", "batch_id")]
    return rows.groupBy("result_key", "field", "channel").agg(total, *other)


class MetricTable:
    def __init__(self, spark: SparkSession, path: str, compact_every: int = 20):
        self.spark, self.path, self.compact_every = spark, path, compact_every

    def table(self, query: str, additive: bool | None = None) -> BatchTable:
        """The batches of one query, which are increments or not from its first batch on."""
        kinds = folder_names(self.spark, f"{self.path}/{query}")
        known = "increments" in kinds if kinds else bool(additive)
        if additive is not None and known != additive:
            raise ValueError(f"{query} is a query of {'increments' if known else 'values'}")
        return BatchTable(
            self.spark, f"{self.path}/{query}/{'increments' if known else 'values'}", _COLUMNS, ["result_key", "field"],
            _added_up if known else _newest_alive, self.compact_every,
        )

    def put(
        self, rows: DataFrame, query: str, batch_id: int, ttl_seconds: int | None = None, channel: str | None = None, additive: bool = False
    ) -> None:
        """Set fields, or with ``additive`` add to them; the same (query, batch_id) replaces what an earlier attempt wrote."""
        now = F.current_timestamp()
        expires = now + F.make_dt_interval(secs=F.lit(float(ttl_seconds))) if ttl_seconds else F.lit(None)
        stamped = rows.select(
            "result_key",
            "field",
            "value",
            now.alias("updated_at"),
            expires.cast("timestamp").alias("expires_at"),
            F.lit(channel).cast("string").alias("channel"),
        )
        self.table(query, additive).put(stamped, batch_id)

    def publish(self, rows: DataFrame, query: str, batch_id: int, channel: str) -> None:
        self.put(rows, query, batch_id, channel=channel)

    def put_once(self, rows: DataFrame, query: str, batch_id: int) -> None:
        """Set only fields that do not exist yet (single writer per query). Of the snapshots only the slots of these fields are read."""
        slots = self.table(query).slots_of(rows)
        known = self.rows(slots).filter(~((F.col("query") == query) & (F.col("batch_id") == batch_id)))
        self.put(rows.join(known, ["result_key", "field"], "left_anti"), query, batch_id)

    def rows(self, slots: list[int] | None = None, query: str | None = None) -> DataFrame:
        """Live rows of all queries, or of one, with ``query`` and ``batch_id``."""
        names = sorted(folder_names(self.spark, self.path)) if query is None else [query]
        parts = [self.table(name).rows(slots).withColumn("query", F.lit(name)) for name in names]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{_COLUMNS}, batch_id bigint, query string")

    def latest(self, query: str | None = None, channel: str | None = None) -> DataFrame:
        """Newest unexpired value of each field."""
        rows = self.rows(query=query)
        if channel:
            rows = rows.filter(F.col("channel") == channel)
        newest = rows.groupBy("result_key", "field").agg(
            F.max(F.struct("batch_id", "updated_at", "value", "expires_at")).alias("r")
        )
        alive = F.col("r.expires_at").isNull() | (F.col("r.expires_at") > F.current_timestamp())
        return newest.filter(alive).select("result_key", "field", F.col("r.value").alias("value"))

    def increments(self, query: str) -> DataFrame:
        """Running totals of fields written as increments."""
        table = self.table(query)
        if table.fold is not _added_up and table.state()["snapshot"] is not None:
            raise ValueError(f"{query} was written as values: its snapshot keeps the newest only")
        rows = table.rows()
        return rows.groupBy("result_key", "field").agg(F.sum(F.col("value").cast("long")).alias("value"))

    def compact(self, query: str, into: str, additive: bool = False) -> None:
        """Write the current values of a query as batch 0 of a new query name."""
        current = self.increments(query) if additive else self.latest(query)
        self.put(current.withColumn("value", F.col("value").cast("string")), into, 0)
