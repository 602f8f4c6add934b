"""JSON message logs: lines, array batches, lenient parsing, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import strip_suffix
from pulsegrid.schema import MESSAGE

__all__ = [
    "infer_json",
    "joined_arrays",
    "parse_lenient",
    "parse_messages",
    "parse_quality",
    "read_lines",
    "split_batches",
    "strip_envelope",
]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One ``payload`` row per text line of files, folders or globs."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def parse_messages(lines: DataFrame, schema: T.StructType = MESSAGE, payload: str = "payload") -> DataFrame:
    """Fields of one JSON object per line, parsed once; the raw text stays for byte counts."""
    parsed = lines.withColumn("_m", F.from_json(payload, schema))
    return parsed.select(*lines.columns, "_m.*")


#: Where one array ends and the next begins, or what looks so inside a text value.
GLUE = r"\]\s*\["


def joined_arrays(payload: str) -> Column:
    """Arrays glued as ``][`` made one array; the same characters inside a text value stay as they are.

    Such a place is inside a value if the quotes before it, escaped ones left out, are odd in number.
    """
    text = F.col(payload)
    pieces = F.split(text, GLUE)
    glue = F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(text, F.lit(f"({GLUE})"), F.lit(1)))

    def take(done: Column, part: Column) -> Column:
        between = F.when(part["g"].isNull(), "").when(done["odd"] == 1, part["g"]).otherwise(",")
        quotes = F.length(F.regexp_replace(F.regexp_replace(part["p"], r"\\.", ""), '[^"]', ""))
        parts = F.concat(done["parts"], F.array(F.concat(between, part["p"])))
        return F.struct(parts.alias("parts"), F.pmod(done["odd"] + quotes, F.lit(2)).alias("odd"))

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("odd"))
    joined = F.aggregate(F.arrays_zip(pieces.alias("p"), glue.alias("g")), start, take, lambda done: F.array_join(done["parts"], ""))
    return F.when(text.rlike(GLUE), joined).otherwise(text)


def split_batches(
    lines: DataFrame, schema: T.StructType = MESSAGE, payload: str = "payload", text: str | None = None
) -> DataFrame:
    """One row per object of a JSON-array batch; arrays glued as ``][`` are joined first.

    ``idx`` is the position of the object in its batch; ``text`` names a column for the whole object, with the
    fields that are not in the schema.
    """
    objects = F.from_json(joined_arrays(payload), "array<string>")
    split = lines.select(*lines.columns, F.posexplode(objects).alias("idx", "_t"))
    kept = [F.col("_t").alias(text)] if text else []
    return split.withColumn("_m", F.from_json("_t", schema)).select(*lines.columns, "idx", *kept, "_m.*")


def parse_lenient(lines: DataFrame, schema: T.StructType = MESSAGE, payload: str = "payload") -> DataFrame:
    """As :func:`parse_messages`; a bad record keeps its row with null fields and ``is_bad`` set."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.withColumn(
        "_m", F.from_json(payload, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    )
    fields = [F.col(f"_m.{name}").alias(name) for name in schema.names]
    is_bad = F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull()
    return parsed.select(*lines.columns, *fields, is_bad.alias("is_bad"))


def parse_quality(parsed: DataFrame) -> DataFrame:
    """Number of good and bad records."""
    return parsed.agg(
        F.count_if(~F.col("is_bad")).alias("good_records"), F.count_if(F.col("is_bad")).alias("bad_records")
    )


def infer_json(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """Parse with the schema that one aggregation over all lines infers."""
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(payload).cast("string")))).first()[0]
    return parse_messages(lines, T.DataType.fromDDL((found or "OBJECT<>").replace("OBJECT<", "STRUCT<")), payload)


def strip_envelope(lines: DataFrame, n_chars: int = 24, payload: str = "payload") -> DataFrame:
    return lines.withColumn(payload, strip_suffix(payload, n_chars))
