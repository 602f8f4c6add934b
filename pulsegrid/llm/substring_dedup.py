"""Repeated passages by difference-cover anchors.

A cover is a set of residues modulo a period that contains every difference between residues. Anchors are
the runs of ``width - period + 1`` words that start at a cover position. If the same ``width`` words
start at i in one text and at j in another, some shift below the period brings both to cover
positions, so both texts hold the same aligned anchor inside the match. Hence only anchors need to be
compared over the whole corpus; a window without a repeated anchor cannot be repeated. The windows
around repeated anchors are then extended to their full width and compared once more, exactly.

Texts are stored in compressed batches of a few MB. For both comparisons a batch sends each distinct
hash once to the owner of its range, and the owner answers which of them some other place has too.
A passage that a third of all texts share thus costs one hash per batch, whatever its copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches, stored
from pulsegrid.llm.words import find_words, hash_windows, hash_words, text_bytes, text_slices

#: Perfect difference sets, each a cover of its period with the fewest residues.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
BATCH_BYTES = 4 << 20
#: Bytes of text per owner of a hash range.
OWNER_BYTES = 16 << 20
HASHES = pa.schema([("batch", pa.int64()), ("owner", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary())])
HASHES_DDL = "batch long, owner long, hashes binary, several binary"
ANSWER = pa.schema([("batch", pa.int64()), ("hashes", pa.binary())])
RESULT_DDL = "doc_id long, n_words long, n_removed long, kept string, removed array<int>"
_U = np.uint64


def cover_for(width: int) -> tuple[int, tuple[int, ...]]:
    """The longest period whose anchors keep at least a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * p <= 2 * width)
    return period, COVERS[period]


class _Texts:
    """Words of the texts of one stored batch."""

    def __init__(self, row: dict) -> None:
        self.ids, self.offsets = row["ids"], np.array(row["offsets"], np.int64)
        self.body = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=int(self.offsets[-1]) + 1)
        self.data = np.frombuffer(self.body, np.uint8)
        starts, ends, self.first = find_words(self.data, self.offsets)
        self.words = hash_words(self.data, starts, ends)
        self.counts = np.diff(self.first)
        self.place = np.arange(len(self.words)) - np.repeat(self.first[:-1], self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place  # words from here to the end of the text

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the run of ``width`` words at each word, and whether the text is long enough there."""
        hashes = hash_windows(self.words, width)
        return hashes, (self.left >= width)[: len(hashes)]

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and word numbers of the anchors of texts that have a window at all."""
        period, cover = cover_for(width)
        hashes, fits = self.windows(width - period + 1)
        residue = np.zeros(period, bool)
        residue[list(cover)] = True
        long_enough = np.repeat(self.counts >= width, self.counts)[: len(hashes)]
        at = np.flatnonzero(fits & long_enough & residue[self.place[: len(hashes)] % period])
        return hashes[at], at


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for i in range(table.num_rows):
        yield {name: table.column(name)[i].as_py() for name in table.schema.names}


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text", BATCH_BYTES):
        data, offsets = text_bytes(part.column("text"))
        body = zstandard.ZstdCompressor(level=3).compress(data.tobytes())
        yield pa.RecordBatch.from_pylist(
            [{"ids": part.column("doc_id").to_pylist(), "offsets": offsets.tolist(), "body": body, "bytes": int(offsets[-1])}],
            pa.schema([("ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("body", pa.binary()), ("bytes", pa.int64())]),
        )


def _send(batch: int, hashes: np.ndarray, owners: int) -> list[dict]:
    """The distinct hashes of a batch by owner, with a bit for those that the batch itself holds several times."""
    distinct, counts = np.unique(hashes, return_counts=True)
    owner = ((distinct >> _U(32)) * _U(owners) >> _U(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    out = []
    for part, several in zip(np.split(np.arange(len(distinct)), cuts), np.split(counts > 1, cuts)):
        if len(part):
            out.append({"batch": batch, "owner": int(owner[part[0]]), "hashes": distinct[part].tobytes(), "several": np.packbits(several).tobytes()})
    return out


def answer(table: pa.Table) -> pa.Table:
    """What the owner of a range sends back to each batch: its hashes that occur somewhere else too."""
    parts = [np.frombuffer(h.as_buffer(), np.uint64) for h in table.column("hashes")]
    several = [np.unpackbits(np.frombuffer(s.as_buffer(), np.uint8), count=len(p)).astype(bool) for s, p in zip(table.column("several"), parts)]
    hashes, again = np.concatenate(parts), np.concatenate(several)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    ends = np.cumsum([len(p) for p in parts])
    rows = []
    for batch, part, flags in zip(table.column("batch").to_pylist(), parts, np.split(again, ends[:-1])):
        if flags.any():
            rows.append({"batch": batch, "hashes": part[flags].tobytes()})
    return pa.Table.from_pylist(rows, ANSWER)


def _known(table: pa.Table) -> np.ndarray:
    parts = [np.frombuffer(h.as_buffer(), np.uint64) for h in table.column("hashes")]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _anchor_sender(width: int, owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for row in _rows(part):
                yield pa.RecordBatch.from_pylist(_send(row["batch"], _Texts(row).anchors(width)[0], owners), HASHES)

    return run


def _window_sender(width: int, owners: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Extends repeated anchors to the windows that hold them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, out = _known(right), []
        for row in _rows(left) if len(known) else ():
            texts = _Texts(row)
            hashes, at = texts.anchors(width)
            at = at[_among(hashes, known)]
            windows, fits = texts.windows(width)
            period = cover_for(width)[0]
            edge = np.zeros(len(texts.words) + 1, np.int64)
            np.add.at(edge, np.maximum(at - period + 1, at - texts.place[at]), 1)
            np.add.at(edge, at + 1, -1)
            near = np.cumsum(edge)[: len(windows)] > 0
            out += _send(row["batch"], windows[near & fits], owners)
        return pa.Table.from_pylist(out, HASHES)

    return run


def _remover(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("removed", pa.list_(pa.int32()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, out = _known(right), []
        for row in _rows(left):
            texts = _Texts(row)
            windows, fits = texts.windows(width)
            edge = np.zeros(len(texts.words) + 1, np.int64)
            at = np.flatnonzero(fits & _among(windows, known))
            edge[at] += 1
            edge[at + width] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            for i, doc_id in enumerate(texts.ids):
                words = texts.body[texts.offsets[i] : texts.offsets[i + 1]].split()
                flags = gone[texts.first[i] : texts.first[i + 1]]
                n = int(flags.sum())
                turns = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0])))).tolist() if n else []
                kept = b" ".join(compress(words, (~flags).tolist()) if n else words)
                out.append({"doc_id": doc_id, "n_words": len(words), "n_removed": n, "kept": kept.decode(), "removed": turns})
        return pa.Table.from_pylist(out, schema)

    return run


def _repeated(sent: DataFrame) -> DataFrame:
    return sent.groupBy("owner").applyInArrow(answer, "batch long, hashes binary")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` text and ``removed`` word spans.

    Each word inside a run of ``width`` words that also starts elsewhere, in the same text or another,
    is removed; all copies are. What is left is joined by single blanks. ``removed`` lists start and end
    (exclusive) of each removed stretch in turn. Null, empty and shorter texts lose nothing; repeated
    rows repeat each other's words; null ids pass through; an empty table gives no rows; other columns
    are not read. Memory of a task follows ``BATCH_BYTES`` or the longest text.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    packed = map_batches(texts, _packer, "ids array<long>, offsets array<long>, body binary, bytes long")
    packed = stored(packed.withColumn("batch", F.monotonically_increasing_id()), "texts")
    owners = max(1, math.ceil((packed.agg(F.sum("bytes")).first()[0] or 0) / OWNER_BYTES))
    whole = packed.select("batch", "ids", "offsets", "body")
    anchors = _repeated(map_batches(whole, _anchor_sender(width, owners), HASHES_DDL))
    windows = whole.groupBy("batch").cogroup(anchors.groupBy("batch")).applyInArrow(_window_sender(width, owners), HASHES_DDL)
    windows = _repeated(windows)
    return whole.groupBy("batch").cogroup(windows.groupBy("batch")).applyInArrow(_remover(width), RESULT_DDL)
