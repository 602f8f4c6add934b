"""Exact duplicates by an extendible-hash index kept on shared files.

1. *Entries.* Tasks reduce their rows to one entry per distinct text: a 64-bit key, the bytes, the ids.
   Entries are written to the shared folder; a text that fills a third of the table becomes one entry
   per 16 MB that a task reads.
2. *Directory.* A histogram over key prefixes of fixed width gives the bytes below each prefix. The
   directory starts with one bucket; an overfull bucket is split by the next bit of the key, and the
   directory doubles when the bucket was as deep as the directory. Buckets are ranges of keys.
3. *Owners.* The entries go to the owner of their bucket, sorted by key. The owner walks through the
   keys, chains the different texts of one key (collisions) and compares bytes, so equal keys alone
   never join two texts.
4. *Verdicts* return to the entries by entry number, which is unique: no hot key is joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import keyed_texts, lower_ascii, packed, stored
from pulsegrid.llm.words import text_bytes, text_slices

#: The directory never has more than 2**MAX_DEPTH pointers, which bounds its histogram and its broadcast.
MAX_DEPTH = 18
ENTRY = "key long, sha string, body binary, ids array<long>, n long, top long"
VERDICT = "entry long, keep_id long, keep_entry long, group_size long"


def _key(body: bytes) -> int:
    return xxhash.xxh64_intdigest(body) - (1 << 63)


def _order(doc_id: int | None) -> tuple[bool, int]:
    return (doc_id is not None, doc_id or 0)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("key", pa.int64()), ("sha", pa.string()), ("body", pa.binary()), ("ids", pa.list_(pa.int64())), ("n", pa.int64()), ("top", pa.int64())]
    )
    for part in text_slices(batches, "text", 16 << 20):
        data, offsets = text_bytes(part.column("text"))
        seen: dict[bytes, list[int | None]] = {}
        for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
            seen.setdefault(data[offsets[i] : offsets[i + 1]].tobytes().lower(), []).append(doc_id)
        rows = []
        for body, ids in seen.items():
            ids.sort(key=_order, reverse=True)
            rows.append((_key(body), hashlib.sha256(body).hexdigest(), body, ids, len(ids), ids[0]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Directory:
    """Pointers from key prefixes to buckets."""

    def __init__(self) -> None:
        self.depth = 0
        self.pointers = [0]  # bucket of each prefix of ``depth`` bits
        self.local = [0]  # depth of each bucket

    def split(self, prefix: int) -> None:
        """Split the bucket of a prefix by one more bit."""
        bucket = self.pointers[prefix]
        if self.local[bucket] == self.depth:
            self.pointers = [b for b in self.pointers for _ in (0, 1)]
            self.depth += 1
            prefix *= 2
        span = 1 << (self.depth - self.local[bucket])
        first = prefix // span * span
        self.local[bucket] += 1
        self.local.append(self.local[bucket])
        for i in range(first + span // 2, first + span):
            self.pointers[i] = len(self.local) - 1


def build_directory(histogram: dict[int, int], capacity: int, width: int = MAX_DEPTH) -> Directory:
    """Double and split until no bucket holds more than ``capacity`` bytes or it is ``width`` bits deep."""
    below = [[histogram.get(i, 0) for i in range(1 << width)]]
    while len(below) <= width:  # below[d][p]: bytes below prefix p of width - d bits
        last = below[-1]
        below.append([last[i] + last[i + 1] for i in range(0, len(last), 2)])
    directory, todo = Directory(), [(0, 0)]
    while todo:
        deep, prefix = todo.pop()
        if deep < width and below[width - deep][prefix] > capacity:
            directory.split(prefix << (directory.depth - deep))
            todo += [(deep + 1, 2 * prefix), (deep + 1, 2 * prefix + 1)]
    return directory


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by bucket and key, in; one verdict per entry, out."""
    schema = pa.schema([(c, pa.int64()) for c in ("entry", "keep_id", "keep_entry", "group_size")])
    at, chain, out = None, [], []

    def close() -> None:
        for group in chain:
            out.extend((e, group["top"], group["keep"], group["n"]) for e in group["entries"])

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        out.clear()
        return made

    for part in batches:
        columns = [part.column(c).to_pylist() for c in ("key", "entry", "n", "top")]
        bodies = part.column("body")
        for i, (key, entry, n, top) in enumerate(zip(*columns)):
            if key != at:
                close()
                at, chain = key, []
                if len(out) > 50_000:
                    yield batch()
            body = bodies[i].as_py()
            group = next((g for g in chain if g["body"] == body), None)
            if group is None:
                chain.append({"body": body, "n": n, "top": top, "keep": entry, "entries": [entry]})
                continue
            group["n"] += n
            group["entries"].append(entry)
            if _order(top) > _order(group["top"]):
                group["top"], group["keep"] = top, entry
    close()
    if out:
        yield batch()


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 8 << 20
) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the text with A-Z lower-cased.

    Of equal texts the row with the largest id stays. A null text equals an empty one. A null id ranks
    below every id; among rows with the same largest id one stays. An empty table gives no rows.
    Other columns are not read, whatever their names.
    """
    texts = keyed_texts(docs, id_col, text_col).select("doc_id", "text")
    entries = stored(texts.mapInArrow(_entries, ENTRY).withColumn("entry", F.monotonically_increasing_id()), "entries")

    prefix = F.shiftrightunsigned("key", 64 - MAX_DEPTH)
    sizes = entries.groupBy(prefix.cast("int").alias("p")).agg(F.sum(F.length("body") + 64).alias("b"))
    histogram = {r["p"]: r["b"] for r in sizes.toLocalIterator()}  # at most 2**MAX_DEPTH counts
    directory = build_directory(histogram, bucket_bytes)
    pointers = docs.sparkSession.createDataFrame(list(enumerate(directory.pointers)), "p long, bucket long")

    shift = F.shiftrightunsigned("key", 64 - directory.depth) if directory.depth else F.lit(0).cast("long")
    placed = entries.select("key", "entry", "n", "top", "body", shift.alias("p")).join(F.broadcast(pointers), "p")
    owned = placed.repartition("bucket").sortWithinPartitions("bucket", "key", "entry")
    verdicts = owned.select("key", "entry", "n", "top", "body").mapInArrow(_owners, VERDICT)

    rows = entries.select("entry", "sha", "ids").join(verdicts, "entry")
    rows = rows.select("*", F.posexplode("ids").alias("place", "doc_id"))
    kept = (F.col("entry") == F.col("keep_entry")) & (F.col("place") == 0)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, with all their columns."""
    kept = exact_groups(docs, id_col, text_col, **options).where("kept").select("doc_id", "text_sha256")
    sha = F.sha2(lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 256)
    rows = packed(docs, F.col(f"`{id_col}`").cast("long").alias("id"), sha.alias("sha"))
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["sha"] == kept["text_sha256"])
    # rows that repeat both id and text meet in the same partition of the join already
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
