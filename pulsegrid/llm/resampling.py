"""Resample documents towards a target: weights from an array of bucket gains, ranks by a distributed radix sort.

Every feature (a word, or a run of words) falls in one of ``buckets`` buckets by its CRC-32. Two passes
over the texts share one array: the first counts the buckets of documents and target, the second adds
up the gain of each feature's bucket. Random Gumbel noise on the weight turns the highest scores into a
draw without replacement.

The order of the scores comes from a least-significant-digit radix sort. A row has a place in a total
order, cut into chunks of equal size. A pass counts (chunk, digit), sums the counts to the offset of each
such cell (all lower digits, then the same digit of earlier chunks), and adds to it a row's number
within its cell, in the old order: that is its new place, and the pass is stable. After the highest
digit the place is the rank. Chunks are cut by place, so that neither equal scores nor equal ids make
one larger than another; no task holds more than some chunks and the driver only one count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches, stored
from pulsegrid.llm.words import find_words, text_bytes, text_slices

BUCKETS = 10_000
DIGIT_BITS = 12
#: Rows of a chunk, once there are enough rows for all cores.
CHUNK_ROWS = 1 << 18
#: Longer features are hashed one by one instead of side by side.
SIDE_BY_SIDE = 64
LAST_ID = (1 << 63) - 1

#: A-Z become a-z; what is neither a digit, a letter nor part of a longer character becomes a blank.
_FOLD = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_first : _last + 1] = np.arange(_first, _last + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _crc_steps() -> np.ndarray:
    """Change of a CRC-32 by each byte: eight steps of the reversed polynomial."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> np.uint32(1)) ^ np.uint32(0xEDB88320), crc >> np.uint32(1))
    return crc


_STEPS = _crc_steps()


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes: the longest first, one byte of all of them at a time."""
    sizes = np.minimum(ends - starts, SIDE_BY_SIDE + 1).astype(np.uint8)
    order = np.argsort(sizes, kind="stable")[::-1]
    begin = starts[order]
    open_at = len(order) - np.cumsum(np.bincount(sizes, minlength=SIDE_BY_SIDE + 2))
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(SIDE_BY_SIDE):
        n = open_at[k]
        if n == 0:
            break
        crc[:n] = _STEPS[(crc[:n] ^ data[begin[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    for i in order[: open_at[SIDE_BY_SIDE]]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def feature_buckets(column: pa.Array, longest: int, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per run length 1 to ``longest``: the buckets of all features, and per text where its own begin (one more at the end)."""
    data, offsets = text_bytes(column)
    data = _FOLD[data]
    starts, ends, first = find_words(data, offsets)
    if longest > 1:  # one blank between the words of a text, so that a run is one span
        keep = np.zeros(len(data) + 1, bool)
        for word_bytes in (starts, ends):
            keep[word_bytes] ^= True
        keep = np.logical_xor.accumulate(keep)[:-1]
        later = np.ones(len(starts), bool)
        later[first[:-1][first[:-1] < len(starts)]] = False
        keep[starts[later] - 1] = True
        moved = np.concatenate(([0], np.cumsum(keep)))
        data, starts, ends = data[keep], moved[starts], moved[ends]
    found, edges = [], []
    for width in range(1, longest + 1):
        runs = np.maximum(np.diff(first) - width + 1, 0)
        edge = np.concatenate(([0], np.cumsum(runs)))
        at = np.repeat(first[:-1] - edge[:-1], runs) + np.arange(edge[-1])
        found.append(crc_spans(data, starts[at], ends[at + width - 1]).astype(np.int64) % buckets)
        edges.append(edge)
    return found, edges


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """``bucket`` and ``n``: features of all texts. A task adds them up in an array of fixed size before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for part in text_slices(batches, "text"):
            for found in feature_buckets(part.column("text"), longest, buckets)[0]:
                sums += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    rows = map_batches(texts.select(F.col(f"`{text_col}`").alias("text")), run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, target_col: str, longest: int, buckets: int) -> list[int]:
    """Gain of each bucket, floor(1000 ln of the smoothed odds); the driver reads ``buckets`` pairs of counts, whatever the data."""
    own = bucket_counts(docs, text_col, longest, buckets).withColumnRenamed("n", "s")
    goal = bucket_counts(target, target_col, longest, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    counts = stored(every.join(own, "bucket", "left").join(goal, "bucket", "left").fillna(0), "buckets")
    all_s, all_t = (float(v) for v in counts.agg(F.sum("s"), F.sum("t")).first())
    up = (F.col("t") + 1).cast("double") * F.lit(all_s + buckets)
    down = (F.col("s") + 1).cast("double") * F.lit(all_t + buckets)
    gains = counts.select("bucket", F.floor(1000 * F.ln(up / down)).alias("gain"))
    return [r.gain for r in gains.orderBy("bucket").collect()]


def score_documents(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    longest: int = 1, buckets: int = BUCKETS, seed: int = 2024,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight`` and ``score`` (longs) of every whole text; see :func:`resample`."""
    spark = docs.sparkSession
    gains = spark.sparkContext.broadcast(np.array(bucket_gains(docs, target, text_col, target_col, longest, buckets), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for part in text_slices(batches, "text"):
            total, count = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            for found, edge in zip(*feature_buckets(part.column("text"), longest, buckets)):
                run_up = np.concatenate(([0], np.cumsum(gain[found])))
                total += run_up[edge[1:]] - run_up[edge[:-1]]
                count += np.diff(edge)
            weight = np.floor_divide(total, np.maximum(count, 1))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count), pa.array(weight)], names=["doc_id", "n_features", "weight"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    weighed = map_batches(rows, run, "doc_id long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise)


def _fields(rows: DataFrame, keys: list[Column]) -> tuple[int, list[tuple[Column, int]]]:
    """Number of rows, and each key as an unsigned number from 0 with the bits that it needs."""
    ends = [f(k) for k in keys for f in (F.min, F.max)]
    n, *bounds = rows.agg(F.count("*"), *ends).first()
    if n == 0:
        return 0, []
    fields = []
    for key, low, high in zip(keys, bounds[::2], bounds[1::2]):
        if high - low <= LAST_ID:
            fields.append((key - F.lit(low), (high - low).bit_length()))
        else:  # the difference may not fit: turn the sign bit, then all 64 bits ascend
            fields.append((key.bitwiseXOR(F.lit(-(1 << 63))), 64))
    return n, fields


def _digit(fields: list[tuple[Column, int]], at: int) -> Column:
    """Bits ``at`` to ``at + DIGIT_BITS`` of the composite key, whose last field has the lowest bits."""
    out, low = F.lit(0).cast("long"), 0
    for value, bits in reversed(fields):
        begin, end = max(at, low), min(at + DIGIT_BITS, low + bits)
        if begin < end:
            part = F.shiftrightunsigned(value, begin - low).bitwiseAND(F.lit((1 << (end - begin)) - 1))
            out = out.bitwiseOR(F.shiftleft(part, begin - at))
        low += bits
    return out.cast("int")


def radix_places(rows: DataFrame, keys: list[Column], name: str = "place") -> DataFrame:
    """Adds the 0-based place of each row in ascending order of the keys, which are longs without null.

    Rows equal in all keys take neighbouring places in any order. An empty table stays empty.
    """
    spark = rows.sparkSession
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "radix")
    n, fields = _fields(placed, keys)
    if n == 0:
        return rows.withColumn(name, F.lit(0).cast("long"))
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // CHUNK_ROWS))
    size = -(-n // chunks)
    placed = placed.withColumn("_chunk", F.pmod(F.xxhash64("_at"), F.lit(chunks)))
    for at in range(0, max(1, sum(bits for _, bits in fields)), DIGIT_BITS):
        placed = stored(_counting_pass(placed, _digit(fields, at), size), "radix")
    return placed.withColumnRenamed("_at", name).drop("_chunk")


def _counting_pass(placed: DataFrame, digit: Column, size: int) -> DataFrame:
    """Stable counting sort by one digit: new place ``_at`` and chunk of every row."""
    placed = placed.withColumn("_digit", digit)
    cells = placed.groupBy("_chunk", "_digit").agg(F.count("*").alias("_n"))
    # at most one row per value of a digit
    lower = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.groupBy("_digit").agg(F.sum("_n").alias("_n")).select("_digit", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_start"))
    # at most one row per chunk
    earlier = Window.partitionBy("_digit").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    offsets = before.join(F.broadcast(starts), "_digit").select("_chunk", "_digit", (F.col("_start") + F.col("_before")).alias("_to"))
    within = F.row_number().over(Window.partitionBy("_chunk", "_digit").orderBy("_at")) - 1
    moved = placed.join(stored(offsets, "offsets").hint("merge"), ["_chunk", "_digit"]).withColumn("_at", F.col("_to") + within)
    return moved.withColumn("_chunk", F.floor(F.col("_at") / size)).drop("_digit", "_to")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    longest: int = 1, buckets: int = BUCKETS, least: int = 20, percent: int = 10, seed: int = 2024,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (longs).

    Of the documents with at least ``least`` words, ``percent`` % of the highest scores are drawn and
    ranked from 1, ties to the smaller id; the rank of the others is null. A null or empty text has no
    features and weight 0. A null id counts as empty in the random number and as the largest in ties;
    rows with one id and score take neighbouring ranks in any order. An empty target leaves the gains of
    smoothing, an empty table gives no rows; other columns are not read.
    """
    scored = score_documents(docs, target, id_col, text_col, target_col, longest, buckets, seed)
    # of n words there are n + (n - 1) + ... runs
    features = sum(max(least - k, 0) for k in range(longest))
    scored = stored(scored, "scores")
    eligible = scored.where(F.col("n_features") >= features)
    placed = radix_places(eligible, [-F.col("score"), F.coalesce("doc_id", F.lit(LAST_ID))])
    drawn = percent * eligible.count() // 100
    ranked = placed.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place")
    rest = scored.where(F.col("n_features") < features).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
