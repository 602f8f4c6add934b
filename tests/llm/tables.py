"""Small tables for the tests of the pipeline operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = "row th text_sha256 kept keep_id words known chars language place size source_size target k u x p n sid bands bucket hub member term spans entity entry ids label_id toxic copies id sha text_hash score".split()


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def documents(spark, rows, clashing=True):
    """Documents with many further columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        df = df.select("*", *[F.lit(f"{name}!").alias(name) for name in CLASHING])
    return df


def odd_rows():
    """Nulls in each column, empty and blank texts, ties, repeated rows and ids, one text of 3 MB."""
    rng = random.Random(5)
    some = prose(rng, 120)
    return [
        (1, some, "en", "a"),
        (2, some.upper().replace("W", "w"), "en", "a"),
        (3, None, "en", "b"),
        (4, "", "de", None),
        (5, " \n\t\x0b ", None, "b"),
        (6, "one", "en", "a"),
        (7, "A, b. ß É 中文 \U0001f600 1234", "xx", ""),
        (8, prose(rng, 80, 5), "en", "b"),
        (9, prose(rng, 500_000, 100_000), "de", "c"),
        (10, some, None, None),
        (10, some, None, None),
        (None, some, "en", "a"),
        (None, None, None, None),
        (11, "word " * 90, "en", "c"),
    ]
