"""Small frame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import work_path

MAX_BATCH_ROWS, MAX_BATCH_BYTES = 2000, 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: fixed rows for every later job, and no lineage to repeat."""
    spark: SparkSession = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and ``th``, a hash that tells apart rows with the same or no id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def packed(docs: DataFrame, *extra: Column) -> DataFrame:
    """The whole row in one column ``row``, so that helper columns cannot clash with names of the table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *extra)


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with batches that stay small when rows are long."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > MAX_BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(MAX_BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MAX_BATCH_BYTES))
    return df.mapInArrow(fn, schema)
