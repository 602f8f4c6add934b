"""The whole streaming report over JSON-array batches: archive, totals, lattice and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pulsegrid.operators.filters import Conditions
from pulsegrid.schema import MESSAGE
from pulsegrid.sinks.archive import archive_stream
from pulsegrid.sources.messages import split_batches
from pulsegrid.streaming.runs import latest_rows, start_into_table
from pulsegrid.streaming.totals import lattice_stream, lattice_subsets, running_totals
from pulsegrid.streaming.windows import event_time, pane_totals, value_counts, window_median, windows_of_panes

__all__ = ["StreamReports"]

# a window of fifty slides of six seconds
WINDOW_SECONDS, SLIDE_SECONDS = 300, 6


class StreamReports:
    """Queries that share a source and keep their tables below one folder.

    ``batches`` has ``payload`` (an array of messages) and ``arrived`` (event time). Each question is
    one query with one state; the windows are read from panes. Totals are kept per ``total_key``.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        conditions: Conditions,
        dims: list[str],
        amount: str = "price",
        schema: T.StructType = MESSAGE,
        delay: str = "10 minutes",
        total_key: str = "brand",
    ):
        self.spark, self.base, self.conditions, self.dims = spark, base, conditions, dims
        self.amount, self.schema, self.delay, self.total_key = amount, schema, delay, total_key
        self.keys = {
            "totals": [total_key], "subsets": ["mask"], "ranks": ["mask", "dim", "value"], "panes": ["pane"], "values": ["pane", amount],
        }

    def start(self, batches: DataFrame, every: str | None = None) -> dict[str, StreamingQuery]:
        """Start all queries; ``every`` is the trigger interval, without it they stop when caught up."""
        raw = batches.withColumn("arrived_ms", F.unix_millis(F.col("arrived").cast("timestamp")))
        # bytes are those of the whole message, fields outside the schema included
        messages = split_batches(batches.select("payload", "arrived"), self.schema, text="message")
        messages = messages.drop("payload").withColumnRenamed("message", "payload")
        timed = event_time(messages, "arrived", self.delay)
        tables = {
            "totals": running_totals(messages, [self.total_key], self.amount, "payload"),
            "subsets": lattice_stream(messages, self.conditions, self.amount, "payload"),
            "ranks": lattice_stream(messages, self.conditions, self.amount, "payload", self.dims),
            "panes": pane_totals(timed, "arrived", SLIDE_SECONDS, None, self.amount, "payload"),
            "values": value_counts(timed, "arrived", SLIDE_SECONDS, self.amount),
        }
        queries = {
            name: start_into_table(df, f"{self.base}/{name}/rows", f"{self.base}/{name}/state", "update", every, keys=self.keys[name])
            for name, df in tables.items()
        }
        writer = archive_stream(raw, f"{self.base}/archive/rows", f"{self.base}/archive/state", arrived="arrived_ms")
        writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
        return {**queries, "archive": writer.start()}

    def _latest(self, name: str) -> DataFrame:
        return latest_rows(self.spark, f"{self.base}/{name}/rows", self.keys[name])

    def totals(self) -> DataFrame:
        return self._latest("totals")

    def subsets(self) -> DataFrame:
        return lattice_subsets(self._latest("subsets"), self.conditions)

    def ranks(self) -> DataFrame:
        return lattice_subsets(self._latest("ranks"), self.conditions)

    def windows(self) -> DataFrame:
        return windows_of_panes(self._latest("panes"), WINDOW_SECONDS, SLIDE_SECONDS)

    def medians(self) -> DataFrame:
        counts = self._latest("values")
        return window_median(counts, WINDOW_SECONDS, SLIDE_SECONDS, self.amount)

    def archive(self) -> str:
        """Path of the archived cells."""
        return f"{self.base}/archive/rows"
