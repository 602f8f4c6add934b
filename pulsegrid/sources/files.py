"""Delimited, vector, Parquet, sequence and whole-file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import clean_number, meter_time, non_negative
from pulsegrid.schema import METER_MEASURES, METER_TEXT, RATING

__all__ = [
    "clean_meter",
    "genres_of_items",
    "read_items",
    "read_labelled_tsv",
    "read_libsvm",
    "read_meter",
    "read_parquet",
    "read_ratings",
    "read_sequence_pairs",
    "read_typed_csv",
    "read_vectors",
    "read_whole_files",
    "rows_in_memory",
    "write_sequence_pairs",
]


def read_meter(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon meter file; a line with a missing marker or a malformed time is dropped."""
    return clean_meter(spark.read.schema(METER_TEXT).csv(path, sep=";", header=False))


def clean_meter(text: DataFrame) -> DataFrame:
    """Typed meter readings from text columns named as ``METER_TEXT``."""
    measures = [F.col(name).try_cast("double").alias(name) for name in METER_MEASURES]
    typed = text.select(meter_time("date", "time").alias("ts"), *measures)
    return typed.dropna()


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """First three tab-separated columns: user, product, rating; further columns are ignored."""
    raw = spark.read.csv(path, sep="\t", header=False)
    kept = raw.select(*raw.columns[:3]).toDF(*RATING.names)
    return kept.select(*[F.col(f.name).cast(f.dataType) for f in RATING])


def read_items(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Pipe-separated items: id, title and the 0/1 flags that start at the sixth column."""
    raw = spark.read.csv(path, sep="|", header=False, encoding=encoding)
    flags = F.array(*[F.col(c) for c in raw.columns[5:]])
    return raw.select(
        F.col(raw.columns[0]).cast("int").alias("id"), F.col(raw.columns[1]).alias("title"), flags.alias("flags")
    )


def genres_of_items(items: DataFrame, genres: DataFrame, id_col: str = "id") -> DataFrame:
    """Names of the set flags of each item, in flag order; ``genres`` has ``name`` and ``index``."""
    set_flags = items.select(id_col, F.posexplode("flags").alias("index", "flag")).filter(F.col("flag") == "1")
    named = set_flags.join(genres.select(F.col("index").cast("int"), "name"), "index")
    # a group is one item's flags, so its list is never longer than the flag array
    lists = named.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("index", "name"))).alias("_g"))
    lists = lists.select(id_col, F.transform("_g", lambda g: g["name"]).alias("genres"))
    return (
        items.drop("flags")
        .join(lists, id_col, "left")
        .withColumn("genres", F.coalesce("genres", F.array().cast("array<string>")))
    )


def read_labelled_tsv(
    spark: SparkSession, path: str, category_at: int = 3, clip_negative: bool = False, header: bool = True
) -> DataFrame:
    """Quoted tab-separated table: ``label``, ``category`` and the cleaned numeric ``features`` array."""
    raw = spark.read.csv(path, sep="\t", quote='"', header=header)
    names = [f"`{c}`" for c in raw.columns]
    numbers = [clean_number(F.col(c)) for c in names[category_at + 1 : -1]]
    if clip_negative:
        numbers = [non_negative(c) for c in numbers]
    return raw.select(
        clean_number(F.col(names[-1])).alias("label"),
        F.col(names[category_at]).alias("category"),
        F.array(*numbers).alias("features"),
    )


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated numbers per line as an ``embedding`` array."""
    numbers = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.cast("double"))
    return spark.read.text(path).filter(F.trim("value") != "").select(numbers.alias("embedding"))


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    if n_features:
        reader = reader.option("numFeatures", str(n_features))
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_sequence_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """Key-value sequence file; keys and values are written as text."""
    pairs = df.select(F.col(key).cast("string"), F.col(value).cast("string"))
    pairs.rdd.map(tuple).saveAsSequenceFile(path)


def read_sequence_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), "key string, value string")


def read_whole_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, content) of every file below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "content")


def rows_in_memory(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
