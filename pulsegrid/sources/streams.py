"""Unbounded sources behind one function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

__all__ = ["offset_report", "open_stream", "replay_log"]


def open_stream(spark: SparkSession, kind: str, location: str, schema: T.StructType | str | None = None, **options: str):
    """Streaming rows of a log, socket or folder.

    ``kafka``: ``location`` is the topic and ``bootstrap`` an option; gives ``payload``.
    ``socket``: ``location`` is ``host:port``; gives ``payload``.
    ``text``: one ``payload`` per line of new files in a folder.
    Any other kind is a file format read with ``schema``.
    """
    options = {key.replace("__", "."): value for key, value in options.items()}
    if kind == "kafka":
        bootstrap = options.pop("bootstrap")
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        return reader.option("subscribe", location).options(**options).load().selectExpr("cast(value as string) payload")
    if kind == "socket":
        host, port = location.rsplit(":", 1)
        reader = spark.readStream.format("socket").option("host", host).option("port", port).options(**options)
        return reader.load().withColumnRenamed("value", "payload")
    if kind == "text":
        return spark.readStream.options(**options).text(location).withColumnRenamed("value", "payload")
    return spark.readStream.format(kind).schema(schema).options(**options).load(location)


def replay_log(spark: SparkSession, bootstrap: str, topic: str, starting: str, ending: str) -> DataFrame:
    """Bounded read of a log between two offset maps (JSON texts by topic and partition)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
        .load()
        .selectExpr("cast(value as string) payload", "partition", "offset")
    )


def offset_report(query: StreamingQuery) -> list[dict]:
    """Start and end offset of each source for the batches the query still remembers."""
    return [
        {
            "batch_id": progress.batchId,
            "source": source.description,
            "start_offset": source.startOffset,
            "end_offset": source.endOffset,
            "rows": source.numInputRows,
        }
        for progress in query.recentProgress
        for source in progress.sources
    ]
