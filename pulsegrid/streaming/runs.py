"""Running a streaming query into a table of batches, and reading that table back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pulsegrid.session import drop_folder, folder_names, work_path
from pulsegrid.streaming.ledger import OffsetLedger

__all__ = ["append_table", "latest_rows", "run_available", "start_into_table", "state_partitions", "store_batch", "stored_batches"]

#: Batches of a table that are merged into one snapshot.
COMPACT_EVERY = 20


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Partitions of the state of queries first started inside: as configured, but at most two per core.

    Every state partition is a task and a file of every batch, and adaptive execution does not merge
    them. A query that continues from a checkpoint keeps the number it began with.
    """
    key = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(key)
    spark.conf.set(key, str(min(int(configured), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, configured)


def start_into_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
    per_batch: Callable[[DataFrame, int], DataFrame] | None = None,
    keys: list[str] | None = None,
    compact_every: int = COMPACT_EVERY,
    ledger: OffsetLedger | None = None,
) -> StreamingQuery:
    """Start a query whose batch ``n`` replaces the folder ``batch_id=n`` of a Parquet table.

    A batch repeated after a failure overwrites its own rows. ``every`` is a trigger interval;
    without it the query handles what is available and stops. With ``keys`` (of an update-mode table)
    every ``compact_every`` batches are merged into a snapshot, and folders that no reader needs go. A
    ``ledger`` keeps the offsets of every batch and the rows that it handed on.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        seen = Observation() if ledger else None
        batch = batch.observe(seen, F.count(F.lit(1)).alias("rows")) if ledger else batch
        rows = per_batch(batch, batch_id) if per_batch else batch
        store_batch(rows, path, batch_id, keys, compact_every)
        if ledger:
            ledger.record(checkpoint, batch_id, seen.get["rows"])

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with state_partitions(stream.sparkSession):
        return writer.start()


def store_batch(rows: DataFrame, path: str, batch_id: int, keys: list[str] | None, compact_every: int = COMPACT_EVERY) -> None:
    """Write one batch, and a snapshot of everything up to it when its turn has come.

    The snapshot starts from the last one before this batch, so a repeated batch gives the same snapshot.
    That last one is kept, with the batches after it; what is older is deleted.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    if keys is None or (batch_id + 1) % compact_every:
        return
    old = [n for n in _numbers(spark, _snapshot(path)) if n < batch_id]
    current = _current(spark, path, keys, old[-1] if old else None, batch_id)
    current.write.mode("overwrite").parquet(f"{_snapshot(path)}/batch_id={batch_id}")
    if old:
        for folder, last in ((path, old[-1]), (_snapshot(path), old[-1] - 1)):
            for n in _numbers(spark, folder):
                if n <= last:
                    drop_folder(spark, f"{folder}/batch_id={n}")


def _snapshot(path: str) -> str:
    return f"{path}_snapshot"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders below a path, in order."""
    return sorted(int(n.removeprefix("batch_id=")) for n in folder_names(spark, path) if n.startswith("batch_id="))


def _current(spark: SparkSession, path: str, keys: list[str], snapshot: int | None, upto: int | None = None) -> DataFrame:
    """Newest row of each key from a snapshot and the batches after it."""
    wanted = [n for n in _numbers(spark, path) if (snapshot is None or n > snapshot) and (upto is None or n <= upto)]
    places = [f"{path}/batch_id={n}" for n in wanted]
    parts = [spark.read.option("basePath", path).parquet(*places)] if places else []
    if snapshot is not None:
        parts.append(spark.read.option("basePath", _snapshot(path)).parquet(f"{_snapshot(path)}/batch_id={snapshot}"))
    return _newest(reduce(DataFrame.unionByName, parts) if parts else spark.read.parquet(path), keys)


def run_available(
    stream: DataFrame,
    name: str,
    mode: str = "update",
    per_batch: Callable[[DataFrame, int], DataFrame] | None = None,
    path: str | None = None,
    keys: list[str] | None = None,
    compact_every: int = COMPACT_EVERY,
    ledger: OffsetLedger | None = None,
) -> str:
    """Run over everything available, wait, and return the path of the table of batches."""
    base = path or work_path(stream.sparkSession, name)
    query = start_into_table(
        stream, f"{base}/rows", f"{base}/checkpoint", mode, per_batch=per_batch, keys=keys, compact_every=compact_every, ledger=ledger
    )
    query.awaitTermination()
    return f"{base}/rows"


def stored_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row of each key in a table of update-mode batches: the last snapshot and the batches after it."""
    snapshots = _numbers(spark, _snapshot(path))
    return _current(spark, path, keys, snapshots[-1] if snapshots else None)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_r")
    grouped = rows.groupBy(*keys).agg(newest) if keys else rows.agg(newest)
    return grouped.select(*keys, "_r.*")


def append_table(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode query over everything available and give its rows."""
    return stored_batches(stream.sparkSession, run_available(stream, name, "append")).drop("batch_id")
