"""Pack the tokens of documents into sequences of fixed length by sums of squares.

A document is its token ids and an end mark; a longer one than a sequence is cut into whole sequences
and a rest. Whole ones are sequences as they are. The others are dealt evenly to shards of a bounded
number of pieces, and each shard places its pieces, longest first, by the sum-of-squares rule: of the
open sequences and a new one, the place after which the squared numbers of open sequences per
residual gap add up to least; of equal places, the tightest. A shard leaves about two sequences more
than its tokens need, whatever the number of shards.

Tokens come from the tokenizer's library. White space never reaches a token of this vocabulary, so a
text is the sequence of its words, and a worker asks the library once per word that it does not know.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches, stored
from pulsegrid.llm.words import text_slices

LENGTH = 4096
END_ID = 1
SHARD_PIECES = 16_384
KNOWN_WORDS = 300_000
LONG_WORD = 64
ASKED_AT_ONCE = 10_000
#: The vocabulary's pattern cuts between a letter and these marks, none of which is part of a special token.
BEFORE_MARKS = r'([A-Za-z])([.,;:!?")]+)'
#: Special tokens begin so; the upper-case form of one is ordinary text.
SPECIAL = "<|"


class WordEncoder:
    """Ids of whole texts by the library, word by word; up to twice ``KNOWN_WORDS`` words are kept."""

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _recall(self, word: str) -> bytes | None:
        ids = self.known.get(word)
        if ids is None and (ids := self.older.get(word)) is not None:
            self.known[word] = ids
        return ids

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as bytes of unsigned 32-bit numbers."""
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        known = self.known
        found = [known.get(w) for w in words]
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self._recall(words[i])
        open_ = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(open_), ASKED_AT_ONCE):
            part = open_[at : at + ASKED_AT_ONCE]
            coded = self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)
            for i, c in zip(part, coded):
                found[i] = np.array(c.ids, np.uint32).tobytes()
                if len(words[i]) <= LONG_WORD:
                    known[words[i]] = found[i]
        return found

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's ids begin (one more at the end).

        Marks behind a word become words of their own and ASCII words lower case, as the tokenizer would
        make them, so that a word is asked for once in all its forms.
        """
        texts = pc.replace_substring_regex(column.fill_null("").cast(pa.large_string()), BEFORE_MARKS, r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        plain = pc.and_(pc.string_is_ascii(flat), pc.invert(pc.match_substring(flat, SPECIAL)))
        coded = pc.if_else(plain, pc.ascii_lower(flat), flat).dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist())
        ends = np.cumsum([0, *[len(b) // 4 for b in ids]])
        per_word = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(ids), np.uint32)))
        taken = per_word.take(coded.indices)
        words, places = split.offsets.to_numpy(), taken.offsets.to_numpy()
        return taken.flatten().to_numpy(), places[words - words[0]] - places[0]


_loaded: dict[int, WordEncoder] = {}


def _encoder(shared) -> WordEncoder:
    """One encoder per Python worker."""
    if shared.value[0] not in _loaded:
        _loaded.clear()
        _loaded[shared.value[0]] = WordEncoder(shared.value[1])
    return _loaded[shared.value[0]]


def cut_pieces(ids: np.ndarray, edges: np.ndarray, length: int, end_id: int) -> dict[str, np.ndarray]:
    """Cut each text's ids and its end mark: ``row`` of the text, ``piece``, ``start`` and ``length``; ``at`` is a piece's place in ``ids``."""
    ids = np.insert(ids, edges[1:], end_id)
    edges = edges + np.arange(len(edges))
    sizes = np.diff(edges)
    counts = -(-sizes // length)
    row = np.repeat(np.arange(len(sizes)), counts)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = piece * length
    return {"ids": ids, "row": row, "piece": piece, "start": start, "length": np.minimum(sizes[row] - start, length), "at": edges[row] + start}


def token_pieces(
    docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, the ``ids`` of every piece of every whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for part in text_slices(batches, "text"):
            cut = cut_pieces(*encoder.texts(part.column("text")), length, end_id)
            raw = memoryview(cut["ids"].astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(cut["at"].tolist(), cut["length"].tolist())]
            made = {"doc_id": part.column("doc_id").take(pa.array(cut["row"]))}
            made |= {c: pa.array(cut[c], t) for c, t in (("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()))}
            made["ids_crc32"] = pa.array(crc, pa.int64())
            if with_ids:  # the pieces follow each other without gaps
                ends = np.append(cut["at"], len(cut["ids"]))
                made["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cut["ids"].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, none of which is as long as a sequence.

    Moving a sequence from gap g to g - s changes the sum of squares by 2 (n(g-s) - n(g)) + 2, closing
    it by 1 - 2 n(g), a new one by 2 n(length - s) + 1.
    """
    open_at: list[list[int]] = [[] for _ in range(length)]
    n = np.zeros(length, np.int64)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    made = 0
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        here = n[s:]
        change = 2 * (n[: length - s] - here) + 2
        change[0] = 1 - 2 * here[0]
        change[here == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if change[best] <= 2 * n[length - s] + 1:
            gap = s + best
            sequence[i] = open_at[gap].pop()
            n[gap] -= 1
        else:
            gap, sequence[i] = length, made
            made += 1
        offset[i] = length - gap
        if gap > s:
            open_at[gap - s].append(sequence[i])
            n[gap - s] += 1
    return sequence, offset


def pack_pieces(pieces: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. Pieces as long as a sequence keep to themselves and have negative sequence ids."""
    pieces = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") >= length)
    parts = pieces.where(F.col("length") < length)
    shards = max(1, -(-parts.count() // shard_pieces))
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        sequence, offset = sum_of_squares(table.column("length").to_numpy(), length)
        sequence += table.column("shard")[0].as_py() << 24
        return table.drop_columns(["uid", "shard"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.drop("uid").schema)
    placed = parts.groupBy("shard").applyInArrow(pack, f"{fields}, sequence_id long, offset long")
    alone = whole.withColumn("sequence_id", -1 - F.col("uid")).withColumn("offset", F.lit(0).cast("long")).drop("uid")
    return placed.unionByName(alone)


def pack_documents(
    docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``, with ``ids`` if wanted.

    A null or empty text is its end mark alone; special tokens written in a text get their ids.
    Repeated rows and null ids are documents of their own; an empty table gives no rows; other columns
    are not read. ``shared`` is the tokenizer file as a broadcast, whose pattern drops white space.
    """
    return pack_pieces(token_pieces(docs, shared, id_col, text_col, length, end_id, with_ids), length)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` and ``length`` of each sequence, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    return whole.withColumn("length", F.size("ids").cast("long"))
