"""Feature columns for tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIME_PARTS = ["year", "month", "day", "hour", "minute"]


def with_time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Calendar parts as text categories."""
    from pulsegrid.functions import date_parts

    return df.withColumns({name: c.cast("string") for name, c in date_parts(ts).items()})


def one_hot_pipeline(categories: list[str], numbers: list[str], output: str = "features") -> Pipeline:
    """One-hot categories followed by numeric columns, as one sparse vector.

    Category order is alphabetic and a value not seen in training gets its own slot, so that the
    encoding is the same on every run and scoring never fails.
    """
    indexer = StringIndexer(
        inputCols=categories,
        outputCols=[f"{c}_index" for c in categories],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    encoder = OneHotEncoder(
        inputCols=indexer.getOutputCols(), outputCols=[f"{c}_hot" for c in categories], dropLast=False
    )
    parts = [*encoder.getOutputCols(), *numbers]
    return Pipeline(stages=[indexer, encoder, VectorAssembler(inputCols=parts, outputCol=output, handleInvalid="error")])


def fit_one_hot(df: DataFrame, categories: list[str]) -> PipelineModel:
    """Encoder of the categories alone, which takes each combination of them once instead of every row."""
    return one_hot_pipeline(categories, []).fit(df.select(*categories).distinct())


def with_one_hot(
    df: DataFrame, encoder: PipelineModel, combinations: DataFrame, categories: list[str], numbers: list[str], output: str = "features"
) -> DataFrame:
    """Adds the vector of :func:`one_hot_pipeline`: each combination of categories is encoded once and joined to its rows.

    ``combinations`` holds all that occur, each once. They are broadcast, so they have to be few, as the days of a calendar are.
    """
    coded = encoder.transform(combinations).select(*[F.col(c).alias(f"_{c}") for c in categories], F.col("features").alias("_hot"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in categories])
    joined = df.join(F.broadcast(coded), same).select(*df.columns, "_hot")
    return VectorAssembler(inputCols=["_hot", *numbers], outputCol=output, handleInvalid="error").transform(joined).drop("_hot")


def standardiser(column: str, output: str, with_mean: bool = True, with_std: bool = True) -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=output, withMean=with_mean, withStd=with_std)


def assembled(df: DataFrame, numbers: list[str], label: str, output: str = "features") -> DataFrame:
    assembler = VectorAssembler(inputCols=numbers, outputCol=output, handleInvalid="error")
    return assembler.transform(df).select(F.col(label).cast("double").alias("label"), output)


def vector_of(array_column: str):
    """Array of numbers as a vector column."""
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(array_column).cast("array<double>"))
