"""Offsets of every batch of a streaming query, kept for good.

A checkpoint's own log forgets old batches and a query's progress forgets them sooner. The ledger
takes each batch's entry from the log while the batch runs and keeps it as rows of a batch table, so a
batch that is repeated after a restart replaces its own entry.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import folder_names, read_text
from pulsegrid.sinks.batch_table import BatchTable, newest_fold

__all__ = ["OffsetLedger", "checkpoint_offsets", "stored_state"]

_ENTRY = "batch int, source int, start_offset string, end_offset string, batch_ms bigint, rows bigint"


def _offsets(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[int | None, list[str | None]]:
    """Time of a batch and the offset that each source reached with it."""
    lines = read_text(spark, f"{checkpoint}/offsets/{batch_id}").split("\n")
    ends = [line if line != "-" else None for line in lines[2:] if line]
    return json.loads(lines[1]).get("batchTimestampMs"), ends


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch``, ``source``, ``end_offset`` and ``committed`` of the batches that a checkpoint still knows."""
    done = set(folder_names(spark, f"{checkpoint}/commits"))
    rows = [
        (int(name), source, end, name in done)
        for name in folder_names(spark, f"{checkpoint}/offsets")
        if name.isdigit()
        for source, end in enumerate(_offsets(spark, checkpoint, int(name))[1])
    ]
    return spark.createDataFrame(rows, "batch int, source int, end_offset string, committed boolean")


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stateful operator holds after the last batch: the fields of its keys and of its values."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


class OffsetLedger:
    def __init__(self, spark: SparkSession, path: str, compact_every: int = 100):
        self.spark = spark
        keys = ["batch", "source"]
        fold = newest_fold(keys, ["start_offset", "end_offset", "batch_ms", "rows"])
        self.table = BatchTable(spark, path, _ENTRY, keys, fold, compact_every, slots=1)

    def record(self, checkpoint: str, batch_id: int, rows: int | None = None) -> None:
        """Keep the entry of a batch that is running or done; ``rows`` is the number it handed to its sink."""
        at, ends = _offsets(self.spark, checkpoint, batch_id)
        known = f"{batch_id - 1}" in folder_names(self.spark, f"{checkpoint}/offsets")
        starts = _offsets(self.spark, checkpoint, batch_id - 1)[1] if known else [None] * len(ends)
        entries = [(batch_id, i, start, end, at, rows) for i, (start, end) in enumerate(zip(starts, ends))]
        self.table.put(self.spark.createDataFrame(entries, _ENTRY), batch_id)

    def rows(self) -> DataFrame:
        return self.table.current().drop("batch_id")

    def gaps(self) -> DataFrame:
        """Batches whose start is not where the batch before them ended; empty when nothing was lost."""
        rows = self.rows()
        before = rows.select((F.col("batch") + 1).alias("batch"), "source", F.col("end_offset").alias("ended"))
        joined = rows.join(before, ["batch", "source"], "left").filter("batch > 0")
        return joined.filter(~F.col("start_offset").eqNullSafe(F.col("ended"))).select("batch", "source", "start_offset", "ended")
