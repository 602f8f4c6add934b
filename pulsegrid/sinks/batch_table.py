"""A table written batch by batch and read from a bounded number of folders.

Every batch has its own folder, so that a repeated batch replaces its own rows. A manifest names the
folders that count: the last snapshot and the batches after it. When ``compact_every`` batches have
gathered, the next batch first folds them and the last snapshot into a new snapshot, dealt by the hash
of the key into ``slots``. Only batches before the one that begins are folded: a streaming query
repeats none of them. Folders are deleted one snapshot later, so that a reader that has just read the
manifest still finds them. There is one writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import drop_folder, folder_names, read_text, write_text

__all__ = ["BatchTable", "additive_fold", "newest_fold"]

Fold = Callable[[DataFrame], DataFrame]


def additive_fold(keys: list[str], sums: list[str]) -> Fold:
    """Rows that are increments: one per key with their sums."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.max("batch_id").alias("batch_id"))


def newest_fold(keys: list[str], values: list[str]) -> Fold:
    """Rows that replace earlier ones: the newest per key."""

    def fold(rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("r")
        return rows.groupBy(*keys).agg(newest).select(*keys, "r.*")

    return fold


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], fold: Fold, compact_every: int = 20, slots: int = 16):
        """``schema`` of the rows without ``batch_id`` and ``slot``; ``fold`` takes and gives rows with ``batch_id``."""
        self.spark, self.path, self.schema, self.keys, self.fold = spark, path, schema, keys, fold
        self.compact_every, self.slots = compact_every, slots

    def slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")

    def state(self) -> dict:
        """Newest manifest: ``snapshot`` (the last batch in it, or null), ``batches`` after it, and ``dead`` folders."""
        names = folder_names(self.spark, f"{self.path}/manifest")
        versions = sorted(n for n in names if n.endswith(".json"))
        if not versions:
            return {"version": 0, "snapshot": None, "batches": [], "dead": []}
        return json.loads(read_text(self.spark, f"{self.path}/manifest/{versions[-1]}"))

    def _commit(self, state: dict) -> dict:
        state = state | {"version": state["version"] + 1}
        write_text(self.spark, f"{self.path}/manifest/{state['version']:012d}.json", json.dumps(state))
        if state["version"] > 2:
            drop_folder(self.spark, f"{self.path}/manifest/{state['version'] - 2:012d}.json")
        return state

    def folders(self) -> list[str]:
        """What a reader opens: at most one snapshot and ``compact_every`` batches."""
        state = self.state()
        snapshot = [] if state["snapshot"] is None else [f"snapshot/upto={state['snapshot']}"]
        return snapshot + [f"batches/batch_id={n}" for n in state["batches"]]

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch. Batches come in ascending order; one that a snapshot has taken in is final and left alone."""
        state = self.state()
        if state["snapshot"] is not None and batch_id <= state["snapshot"]:
            return
        if len([n for n in state["batches"] if n < batch_id]) >= self.compact_every:
            state = self._compact(state, batch_id)
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        if batch_id not in state["batches"]:
            self._commit(state | {"batches": sorted([*state["batches"], batch_id])})

    def _compact(self, state: dict, before: int) -> dict:
        """Fold the snapshot and the batches before one into a new snapshot."""
        old = [n for n in state["batches"] if n < before]
        folded = self.fold(self._read(state | {"batches": old}))
        columns = [*self.spark.createDataFrame([], self.schema).columns, "batch_id"]
        place = f"{self.path}/snapshot/upto={old[-1]}"
        dealt = folded.select(*columns).withColumn("slot", self.slot()).repartition("slot")
        dealt.write.mode("overwrite").partitionBy("slot").parquet(place)
        dead = [f"batches/batch_id={n}" for n in old] + ([] if state["snapshot"] is None else [f"snapshot/upto={state['snapshot']}"])
        for folder in state["dead"]:
            drop_folder(self.spark, f"{self.path}/{folder}")
        return self._commit(state | {"snapshot": old[-1], "batches": [n for n in state["batches"] if n >= before], "dead": dead})

    def _read(self, state: dict) -> DataFrame:
        read = self.spark.read.schema(f"{self.schema}, batch_id bigint")
        out = self.spark.createDataFrame([], f"{self.schema}, batch_id bigint, slot int")
        if state["batches"]:
            root = f"{self.path}/batches"
            out = read.option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in state["batches"]]).withColumn("slot", self.slot())
        if state["snapshot"] is not None:
            place = f"{self.path}/snapshot/upto={state['snapshot']}"
            kept = self.spark.read.schema(f"{self.schema}, batch_id bigint, slot int").option("basePath", place).parquet(place)
            out = out.unionByName(kept) if state["batches"] else kept
        return out

    def rows(self, slots: list[int] | None = None) -> DataFrame:
        """Live rows with ``batch_id``; with ``slots`` only those folders of the snapshot are opened."""
        found = self._read(self.state())
        return (found if slots is None else found.filter(F.col("slot").isin(slots))).drop("slot")

    def current(self, slots: list[int] | None = None) -> DataFrame:
        """The rows folded to what holds now."""
        return self.fold(self.rows(slots))

    def slots_of(self, rows: DataFrame) -> list[int]:
        """The slots (at most ``slots`` numbers) in which the keys of some rows lie."""
        return [r.slot for r in rows.select(self.slot().alias("slot")).distinct().collect()]
