"""Record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("SID", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("ram", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("COUNT", T.LongType()),
        T.StructField("saleTime", T.LongType()),
    ]
)

READING = T.StructType(
    [
        T.StructField("SID", T.StringType()),
        T.StructField("UA", T.DoubleType()),
        T.StructField("UB", T.DoubleType()),
        T.StructField("UC", T.DoubleType()),
        T.StructField("IA", T.DoubleType()),
        T.StructField("jg", T.LongType()),
    ]
)

METER_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "date",
            "time",
            "active_kw",
            "reactive_kw",
            "voltage",
            "intensity",
            "kitchen",
            "laundry",
            "bedroom",
        )
    ]
)
METER_MEASURES = METER_TEXT.names[2:]

RATING = T.StructType(
    [
        T.StructField("user", T.IntegerType()),
        T.StructField("product", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
    ]
)

CELL = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
