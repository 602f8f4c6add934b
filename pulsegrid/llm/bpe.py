"""Byte-level BPE: speculate, verify, and merge exactly only where the guess fails.

A text is cut into pieces by the vocabulary's pattern. For the new pieces of a batch, greedy longest
match proposes tokens. A sequence of tokens is the BPE encoding of its bytes exactly if each adjacent
pair of tokens is the encoding of the pair's bytes, so all adjacent pairs of the batch are tested at
once: distinct pairs are looked up in what earlier batches have learnt, new ones are merged once.
Pieces with a failing pair are merged exactly by rank. Known pieces are kept up to a fixed number.

Rows never depend on each other: there is no shuffle.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches
from pulsegrid.llm.words import text_slices

#: The white space of Unicode, and the piece pattern of the byte-level vocabulary.
SPACES = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Coarser cuts that every piece respects: a run of other characters with the blank before it, or white space.
CHUNK = re.compile(rf" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
SAFE_CUT = re.compile(rf"(?<=[^{SPACES}]) (?=[^{SPACES}])")
BLOCK_CHARS = 1 << 20
KNOWN_PIECES = 150_000
KNOWN_PAIRS = 200_000
SLICE_BYTES = 1 << 20
SHORT = 48


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself, or the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class HashTable:
    """Whole columns of non-negative 64-bit keys looked up at once; a key that is absent gives ``absent``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, absent: int) -> None:
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, absent, np.int64)
        todo, at = np.arange(len(keys)), self._place(keys)
        while len(todo):  # each free place goes to one of its keys, the others move on
            taken = self.keys[at] >= 0
            self.keys[at[~taken]] = keys[todo[~taken]]
            won = self.keys[at] == keys[todo]
            self.values[at[won]] = values[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._place(keys)
        found, out = self.keys[at], self.values[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & ((1 << self.bits) - 1)
            found = self.keys[at]
            out[open_] = self.values[at]
            more = (found != keys[open_]) & (found >= 0)
            open_, at = open_[more], at[more]
        return out


class Vocabulary:
    """Token bytes, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        step = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or step["type"] != "ByteLevel" or step["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normaliser and prefix blank is supported")
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        names = spec["model"]["vocab"]
        ids = {raw(t): i for t, i in names.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max([*names.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.bytes[i] = token
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.size = len(self.bytes)
        self.texts = pa.array(self.bytes, pa.large_binary())
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.merged = np.array([names[a + b] for a, b in pairs], np.int64)
        self.never = len(pairs)
        self.rank_of = {(names[a], names[b]): r for r, (a, b) in enumerate(pairs)}
        self.ranks = HashTable(np.array([a * self.size + b for a, b in self.rank_of], np.int64), np.arange(len(self.rank_of)), self.never)
        self._grow_trie(ids)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _grow_trie(self, ids: dict[bytes, int]) -> None:
        """``steps``: (node, byte) to node; ``token``: the token that ends at a node, or -1."""
        nodes: dict[int, int] = {}
        token = [-1]
        for name, i in ids.items():
            node = 0
            for byte in name:
                key = node << 8 | byte
                if key not in nodes:
                    nodes[key] = len(token)
                    token.append(-1)
                node = nodes[key]
            token[node] = i
        self.token = np.array(token, np.int64)
        self.steps = HashTable(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int64), -1)

    def guess(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all pieces side by side; ``ends`` are the ends of the pieces in ``data``.

        Returns the tokens of all pieces in order, and how many each piece has.
        """
        at = np.concatenate(([0], ends[:-1]))
        piece = np.flatnonzero(at < ends)
        at = at[piece]
        owners, tokens = [], []
        while len(piece):
            best, length = self.single[data[at]], np.ones(len(at), np.int64)
            row, node, depth = np.arange(len(at)), np.zeros(len(at), np.int64), 0
            while len(row):
                node = self.steps.get(node << 8 | data[at[row] + depth])
                depth += 1
                alive = node >= 0
                row, node = row[alive], node[alive]
                ending = self.token[node] >= 0
                best[row[ending]], length[row[ending]] = self.token[node[ending]], depth
                inside = at[row] + depth < ends[piece[row]]
                row, node = row[inside], node[inside]
            owners.append(piece)
            tokens.append(best)
            at = at + length
            more = at < ends[piece]
            piece, at = piece[more], at[more]
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([np.zeros(0, np.int64), *tokens])[order], np.bincount(owner, minlength=len(ends))

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact encoding of all pieces side by side: the pair of lowest rank, leftmost first, until none is left."""
        ids = self.single[data]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_ids, done_owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ranks = np.full(len(ids), self.never)  # of each token with the next one of its piece
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inner] = self.ranks.get(ids[inner] * self.size + ids[inner + 1])
        while len(ids):
            new = np.ones(len(ids), bool)
            new[1:] = owner[1:] != owner[:-1]
            starts = np.flatnonzero(new)
            least = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(ids)))
            if (least == self.never).any():
                ready = np.repeat(least == self.never, lengths)
                done_ids.append(ids[ready])
                done_owner.append(owner[ready])
                ids, owner, ranks = ids[~ready], owner[~ready], ranks[~ready]
                lengths, least = lengths[least < self.never], least[least < self.never]
                if not len(ids):
                    break
            spot = np.flatnonzero(ranks == np.repeat(least, lengths))
            spot = spot[np.concatenate(([True], owner[spot[1:]] != owner[spot[:-1]]))]
            ids[spot] = self.merged[ranks[spot]]
            keep = np.ones(len(ids), bool)
            keep[spot + 1] = False
            spot -= np.arange(len(spot))  # one token is gone before each later spot
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            for left in (spot - 1, spot):
                left = left[(left >= 0) & (left + 1 < len(ids))]
                left = left[owner[left] == owner[left + 1]]
                ranks[left] = self.ranks.get(ids[left] * self.size + ids[left + 1])
            last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
            ranks[last] = self.never
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(owner, minlength=len(sizes))

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same for one long piece, with a heap over a linked list."""
        ids, ranks = self.single[np.frombuffer(piece, np.uint8)].tolist(), self.rank_of
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    pair = (ids[left], ids[after[left]])
                    if pair in ranks:
                        heapq.heappush(heap, (ranks[pair], left, pair))
        return np.array([x for x in ids if x >= 0], np.int64)

    def _compatible(self, codes: np.ndarray) -> np.ndarray:
        """Whether the two tokens of each pair are what merging their bytes gives."""
        distinct, where = np.unique(codes, return_inverse=True)
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        new = [c for c in distinct.tolist() if c not in self.pairs]
        if new:
            parts = [self.bytes[c // self.size] + self.bytes[c % self.size] for c in new]
            ids, sizes = self.merge(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))
            first = np.cumsum(sizes) - sizes
            two = sizes == 2
            same = two & (ids[first] * self.size + ids[np.minimum(first + 1, len(ids) - 1)] == np.array(new))
            self.pairs.update(zip(new, same.tolist()))
        return np.fromiter((self.pairs[c] for c in distinct.tolist()), bool, len(distinct))[where]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as 32-bit numbers, of many pieces: guesses, one test of all adjacent pairs, exact merging where it fails."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ids, sizes = self.guess(data, np.cumsum(lengths))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        failing = np.zeros(len(pieces), bool)
        failing[owner[inner][~self._compatible(ids[inner] * self.size + ids[inner + 1])]] = True
        failing[sizes == 1] = ~self._reachable()[ids[np.cumsum(sizes)[sizes == 1] - 1]]
        out = _split(ids, sizes)
        short = np.flatnonzero(failing & (lengths <= SHORT))
        if len(short):
            ids, sizes = self.merge(np.frombuffer(b"".join([pieces[k] for k in short.tolist()]), np.uint8), lengths[short])
            for k, exact in zip(short.tolist(), _split(ids, sizes)):
                out[k] = exact
        for k in np.flatnonzero(failing & (lengths > SHORT)).tolist():
            out[k] = self.merge_long(pieces[k]).astype(np.int32).tobytes()
        return out

    def _reachable(self) -> np.ndarray:
        """Whether merging a token's own bytes gives the token; worked out once."""
        if not hasattr(self, "reach"):
            short = [t if len(t) <= 4 * SHORT else b"" for t in self.bytes]
            ids, sizes = self.merge(np.frombuffer(b"".join(short), np.uint8), np.array([len(t) for t in short]))
            first = np.minimum(np.cumsum(sizes) - sizes, len(ids) - 1)
            self.reach = (sizes == 1) & (ids[first] == np.arange(self.size))
        return self.reach

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not known yet. When the memory is full, only chunks in use are carried over."""
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces, self.older = {}, self.pieces
        new = []
        for chunk in chunks.difference(self.pieces):
            ids = self.older.get(chunk)
            if ids is None:
                new.append(chunk)
            else:
                self.pieces[chunk] = ids
        if not new:
            return
        cut = [(c,) if c.isalpha() or (c[0] == " " and c[1:].isalpha()) else PIECE.findall(c) for c in new]
        distinct = list({p for ps in cut for p in ps})
        ids = dict(zip(distinct, self.encode_pieces([p.encode() for p in distinct])))
        for chunk, ps in zip(new, cut):
            self.pieces[chunk] = ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps])

    def stretches(self, text: str) -> Iterator[list[str] | int]:
        """The chunks of a text, in stretches of bounded length, and the ids of special tokens between them."""
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                yield self.special[part]
                continue
            at = 0
            while at < len(part):
                cut = SAFE_CUT.search(part, at + BLOCK_CHARS) if len(part) - at > BLOCK_CHARS else None
                end = cut.start() if cut else len(part)
                yield CHUNK.findall(part[at:end])
                at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids, as 32-bit numbers, of whole texts; the new chunks of all texts are learnt together."""
        done, cut, waiting = [], [], 0
        for k, text in enumerate(texts):
            for stretch in self.stretches(text):
                cut.append((k, stretch))
                waiting += len(stretch) if isinstance(stretch, list) else 1
                if waiting > BLOCK_CHARS:
                    self._settle(cut, done)
                    waiting = 0
        self._settle(cut, done)
        out = [b""] * len(texts)
        parts: dict[int, list[bytes]] = {}
        for k, ids in done:
            parts.setdefault(k, []).append(ids)
        for k, ids in parts.items():
            out[k] = b"".join(ids)
        return out

    def _settle(self, cut: list, done: list) -> None:
        self.learn(set().union(*[stretch for _, stretch in cut if isinstance(stretch, list)]))
        known = self.pieces
        for k, stretch in cut:
            done.append((k, b"".join([known[c] for c in stretch]) if isinstance(stretch, list) else np.int32(stretch).tobytes()))
        cut.clear()

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids; bytes that are not UTF-8 become U+FFFD."""
        flat = self.texts.take(ids.values.slice(ids.offsets[0].as_py(), ids.offsets[-1].as_py() - ids.offsets[0].as_py()))
        ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        offsets = ids.offsets.to_numpy()
        places = pa.py_buffer(np.ascontiguousarray(ends[offsets - offsets[0]]))
        data = flat.buffers()[2] if len(flat) else None
        made = pa.Array.from_buffers(pa.large_string(), len(ids), [None, places, data or pa.py_buffer(b"")])
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([b.as_py().decode("utf-8", "replace") for b in made.cast(pa.large_binary(), safe=False)], pa.string())
        return made.cast(pa.string())


def _split(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = ids.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One vocabulary per Python worker."""
    if shared.value[0] not in _loaded:
        _loaded.clear()
        _loaded[shared.value[0]] = Vocabulary(shared.value[1])
    return _loaded[shared.value[0]]


def share_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (a few MB, whatever the data) as a broadcast; ``path`` is read by the driver."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    return spark.sparkContext.broadcast((hash(content), content))


def _passed(df: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)


def _encode_slice(vocabulary: Vocabulary, part: pa.RecordBatch) -> pa.ListArray:
    coded = vocabulary.encode(part.column("text").to_pylist())
    ends = np.cumsum([0, *[len(c) // 4 for c in coded]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))


def encode_texts(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of every whole text; with ``decoded`` also the text that the ids decode to.

    A null or empty text has no ids; special tokens written in a text get their ids; nothing is added
    or cut. Each row is its own, so repeated rows and null ids pass through; other columns are not read.
    Decoding in the same worker spares a second one per core with a vocabulary of its own.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for part in text_slices(batches, "text", SLICE_BYTES):
            ids = _encode_slice(vocabulary, part)
            made = {"doc_id": part.column("doc_id"), "ids": ids} | ({"decoded": vocabulary.decode(ids)} if decoded else {})
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return map_batches(rows, run, f"{_passed(rows, ['doc_id'])}, ids array<int>" + ", decoded string" * decoded)


def decode_ids(tokens: DataFrame, shared, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids, special tokens included; bytes that are not UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = vocabulary.decode(part.column(ids_col).fill_null([]))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "decoded"])

    return map_batches(tokens, run, f"{_passed(tokens, tokens.columns)}, decoded string")
