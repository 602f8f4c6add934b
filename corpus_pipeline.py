"""From raw documents to token counts: the stages of a training-data pipeline.

Each stage takes and returns documents; the last returns one row of token digests per document row
that the mix took (a document taken twice is two rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.bpe import encode_texts, share_vocabulary
from pulsegrid.llm.exact_dedup import drop_exact_copies
from pulsegrid.llm.frames import stored
from pulsegrid.llm.mixing import take_mix
from pulsegrid.llm.near_dedup import drop_near_copies
from pulsegrid.llm.quality import keep_quality
from pulsegrid.llm.queries import default_vocabulary
from pulsegrid.session import pin_session


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 80 % of their five-word shingles."""
    return drop_near_copies(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the tokens, and the digest of the text they decode to."""
    shared = share_vocabulary(spark, default_vocabulary())
    tokens = encode_texts(docs, shared, decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mix", mix_stage),
    ("tokens", token_stage),
]
#: Signatures, random odds by Spark's hash and BPE have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pin_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
