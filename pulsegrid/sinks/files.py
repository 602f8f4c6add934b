"""Text, Parquet and console output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["console", "write_lines", "write_projection", "write_rows"]


def write_lines(df: DataFrame, path: str, sep: str = ",") -> None:
    """One text line per row; an existing output is replaced."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_projection(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    df.select(*columns).write.mode(mode).parquet(path)


def write_rows(df: DataFrame, path: str) -> None:
    """Append typed rows to a Parquet table."""
    df.write.mode("append").parquet(path)


def console(stream: DataFrame, mode: str = "update", rows: int = 20):
    """Streaming writer that prints the first rows of every batch."""
    return stream.writeStream.outputMode(mode).format("console").option("numRows", rows)
