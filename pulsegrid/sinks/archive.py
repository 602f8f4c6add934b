"""Archive of message batches as time-keyed cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.sources.keyrange import day_of_millis
from pulsegrid.sources.messages import joined_arrays

__all__ = ["archive_cells", "archive_stream", "batch_log"]


def archive_cells(batches: DataFrame, arrived_ms: Column, payload: str = "payload") -> DataFrame:
    """One cell per message of a batch: key = arrival ms, qualifier ``SID_position``.

    Arrays glued as ``][`` are one batch, as for the totals; a message without ``SID`` is stored under its
    position alone. A batch that is not an array of objects gives no cells.
    """
    objects = F.from_json(joined_arrays(payload), "array<string>")
    return (
        batches.select(arrived_ms.cast("long").alias("row_key"), F.posexplode(objects).alias("idx", "value"))
        .withColumn("sid", F.coalesce(F.get_json_object("value", "$.SID"), F.lit("")))
        .select(
            "row_key", F.lit("cf").alias("family"), F.concat_ws("_", "sid", "idx").alias("qualifier"), "value"
        )
    )


def archive_stream(stream: DataFrame, path: str, checkpoint: str, payload: str = "payload", arrived: str | None = None):
    """Streaming writer that stores every batch's cells by day. The file sink commits each batch
    once, so a restart neither loses nor repeats cells."""
    at = F.col(arrived) if arrived else F.unix_millis(F.current_timestamp())
    cells = archive_cells(stream, at, payload).withColumn("day", day_of_millis("row_key"))
    return (
        cells.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def batch_log(df: DataFrame, path: str, batch_id: int) -> None:
    """Text lines of one batch with its id and time; a retried batch replaces its own lines."""
    line = F.concat_ws(" ", F.lit(str(batch_id)), F.current_timestamp().cast("string"), F.to_json(F.struct("*")))
    df.select(line.alias("value")).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
