"""Resampling, manifest and packing against plain Python on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tables import SCHEMA, documents, odd_rows, prose
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, manifest, packing, queries, resampling
from pyspark.sql import functions as F

FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# resampling


def features(text, longest):
    words = FEATURE.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain_scores(rows, target, longest, buckets, seed):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest))
    own, goal = count(t for _, t in rows), count(target)
    all_s, all_t = sum(own.values()), sum(goal.values())
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * (all_s + buckets) / ((own[b] + 1) * (all_t + buckets)))) for b in own}
    out = []
    for doc_id, text in rows:
        found = [gain[zlib.crc32(f.encode()) % buckets] for f in features(text, longest)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    return out


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 97, 35)])
def test_draw_equals_plain_scores_and_order(spark, longest, buckets, percent):
    rng = random.Random(longest)
    rows = [(i * 7 - 90, prose(rng, rng.choice([0, 5, 19, 20, 60]), 50 + i % 40)) for i in range(160)] + [(10_000, None), (10_001, "É中 Ab-c_d\tx9 " * 12)]
    target = [prose(rng, 50, 60) for _ in range(20)] + [None, "w1 w1"]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, goal, longest=longest, buckets=buckets, percent=percent).collect()
    want = plain_scores(rows, target, longest, buckets, 2024)
    long_enough = {i for i, t in rows if len(features(t, 1)) >= 20}
    order = sorted((w for w in want if w[0] in long_enough), key=lambda w: (-w[3], w[0]))[: percent * len(long_enough) // 100]
    rank = {w[0]: k for k, w in enumerate(order, 1)}
    assert sorted(tuple(r) for r in got) == sorted((*w, rank.get(w[0])) for w in want)


def test_crc_of_spans():
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 2, 3, 63, 64, 65, 66, 1000, 5, 5]]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    assert resampling.crc_spans(data, ends - [len(w) for w in words], ends).tolist() == [zlib.crc32(w) for w in words]
    assert resampling.crc_spans(data, ends[:0], ends[:0]).tolist() == []


def _places(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    placed = resampling.radix_places(df, [F.col("a"), F.col("b")]).collect()
    assert sorted(r.place for r in placed) == list(range(len(rows)))
    assert [(r.a, r.b) for r in sorted(placed, key=lambda r: r.place)] == sorted((a, b) for a, b, _ in rows)


@pytest.mark.parametrize("bits", [3, 12])
def test_radix_places_sort_by_all_keys(spark, bits, monkeypatch):
    monkeypatch.setattr(resampling, "DIGIT_BITS", bits)
    rng = random.Random(bits)
    _places(spark, [(rng.randrange(-300, 300), rng.randrange(5, 40), i) for i in range(700)])


def test_radix_places_of_wide_keys_and_one_hot_key(spark):
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1, 1]
    _places(spark, [(7, e, i) for i, e in enumerate(ends * 3)] + [(7, 5, i) for i in range(500)])


def test_a_pass_is_stable(spark):
    placed = spark.createDataFrame([(i, i % 7, i % 3) for i in range(400)], "_at long, _chunk long, v long")
    moved = resampling._counting_pass(placed, F.col("v").cast("int"), 60).collect()
    old = sorted(((i % 7, i) for i in range(400)))
    want = [i for digit in range(3) for _, i in old if i % 3 == digit]
    assert sorted(r._at for r in moved) == list(range(400))
    got = {r._at: r.v for r in moved}
    assert [got[k] for k in range(400)] == [i % 3 for i in want]
    assert all(r._chunk == r._at // 60 for r in moved)


def test_empty_draw(spark):
    none, one = spark.createDataFrame([], SCHEMA), documents(spark, [(1, "a b", "en", "s")])
    assert resampling.resample(none, one).count() == 0
    got = resampling.resample(one, none).first()
    assert (got.n_features, got["rank"]) == (2, None)


# manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """Root, and per node its siblings from the bottom with their sides."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for path, p in zip(paths, place):
            path.append(("-", "") if p ^ 1 >= len(nodes) else ("l" if p & 1 else "r", nodes[p ^ 1]))
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        place = [p // 2 for p in place]
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, sides) of (doc_id, lang, leaf)."""
    groups = defaultdict(list)
    for doc_id, lang, leaf in rows:
        groups[lang].append((doc_id is None, doc_id or 0, leaf, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in order]
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), top in zip(order, trees, tops):
        for (_, _, leaf, doc_id), path in zip(sorted(groups[g], key=lambda m: m[:3]), paths):
            path = path + top
            out.append((doc_id, leaf, subroot, root, "".join(s for _, s in path), "".join(s for s, _ in path)))
    return out


def _known(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_equals_plain_trees(spark, levels, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "WIDE", 1 << levels)
    rng = random.Random(levels)
    sizes = {"en": 133, "de": 64, "": 17, None: 5, "zz": 1, "é": 2, "Z": 33}
    rows = [(rng.randrange(10**6), f"text {i} é", g, rng.choice(["a", None, ""])) for g, n in sizes.items() for i in range(n)]
    docs = documents(spark, rows)
    got = manifest.build_manifest(docs, columns=("doc_id", "source", "lang", "text"))
    want = plain_manifest([(i, g, plain_leaf([i, s, g, t])) for i, t, g, s in rows])
    assert _known(tuple(r) for r in got.drop("seen").collect()) == _known(want)
    good = manifest.fold(F.col("leaf"), F.col("proof"), F.col("sides")) == F.col("root")
    bad = manifest.fold(F.sha2("leaf", 256), F.col("proof"), F.col("sides")) == F.col("root")
    assert got.where(good).count() == len(rows) and got.where(bad).count() == 0


def test_manifest_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = manifest.build_manifest(docs, columns=("doc_id", "source", "lang", "text"))
    want = plain_manifest([(i, g, plain_leaf([i, s, g, t])) for i, t, g, s in odd_rows()])
    assert _known(tuple(r) for r in got.drop("seen").collect()) == _known(want)
    assert manifest.build_manifest(spark.createDataFrame([], SCHEMA), columns=("doc_id", "text")).count() == 0
    lone = manifest.build_manifest(spark.createDataFrame([(1, "a", None, None)], SCHEMA), columns=("doc_id", "text")).first()
    assert lone.leaf == lone.subroot == lone.root == plain_leaf([1, "a"]) and lone.proof == lone.sides == ""


def test_tampered_rows_do_not_verify(spark):
    rows = [(i, f"t{i}", "en", "s", None if i % 5 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA + ", n_chars long")
    changed = F.when(F.col("doc_id") % 3 == 0, manifest.leaf_digest([F.col("doc_id"), F.col("n_chars") + 1]))
    got = manifest.build_manifest(df, columns=("doc_id", "n_chars"), seen=changed)
    folded = manifest.fold(F.coalesce("seen", "leaf"), F.col("proof"), F.col("sides")) == F.col("root")
    for r in got.select("doc_id", folded.alias("ok")).collect():
        assert r.ok == (r.doc_id % 3 != 0 or r.doc_id % 5 == 0)


# packing


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(queries.word_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


ODD_TEXTS = [
    None, "", "  \n\t ", "It's we'll they'VE 'S don't", "a<|endoftext|>b <|startoftext|> <|endof text|>", "Straße ÉCOLE é ́x İI ΣΑΣ ﬁ",
    "x" * 70_000, "a b c\u0085d　e\x1cf\x1fg﻿", "1234 12,5 a1b2 _x_ a_b C++ www.a-b.c/d?e=f", "\U0001f600‍\U0001f525 中文 かな 한국어 ไทย", "end.", "END!?...", "\x00nul\x7f",
    "Hello, (world) [x] {y}; \"q\" 'r' it''s a-b",
]


def test_word_ids_equal_the_library(library):
    with open(queries.word_vocabulary(), encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    rng = random.Random(8)
    alphabet = "aAbE '’.,!<|>_-\n\t ́éÉß中1²½ǅΣςẛ̣"
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, edges = encoder.texts(pa.array(part, pa.string()))
        for text, a, b in zip(part, edges, edges[1:]):
            assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_known_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    with open(queries.word_vocabulary(), encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    rng = random.Random(2)
    for _ in range(20):
        text = " ".join(f"{rng.choice('abcdef')}{rng.choice('xyzuvw')}{rng.randrange(9)}." for _ in range(40))
        assert encoder.texts(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 50 + 80


def plain_packing(sizes, length):
    """Sum of squares by trying every open sequence, as sequences of sizes."""
    open_, used = {}, []
    for s in sorted(sizes, reverse=True):
        gaps = Counter(open_.values())
        tries = []
        for gap in sorted({g for g in gaps if g >= s}) + [None]:
            after = gaps.copy()
            if gap is not None:
                after[gap] -= 1
            left = (length if gap is None else gap) - s
            if left:
                after[left] += 1
            tries.append((sum(v * v for v in after.values()), length + 1 if gap is None else gap))
        gap = min(tries)[1]
        if gap > length:
            used.append([])
            b, gap = len(used) - 1, length
        else:
            b = max(k for k, g in open_.items() if g == gap)
        used[b].append(s)
        open_.pop(b, None)
        if gap > s:
            open_[b] = gap - s
    return used


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_equals_trying_all(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, rng.choice([8, 30])) for _ in range(150)]
    sequence, offset = packing.sum_of_squares(np.array(sizes), 30)
    got = defaultdict(list)
    for s, b, o in sorted(zip(sizes, sequence.tolist(), offset.tolist()), key=lambda x: x[2]):
        assert sum(got[b]) == o
        got[b].append(s)
    assert len(got) == len(plain_packing(sizes, 30))
    assert Counter(map(sum, got.values())) == Counter(map(sum, plain_packing(sizes, 30)))


def test_packing_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 40)
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.choice([0, 3, 30, 31, 32, 90, 200]), 90), "en", "s") for i in range(150)]
    rows += [(1000 + i, t, None, None) for i, t in enumerate(ODD_TEXTS)] + [(1000, None, None, None), (None, "x", None, None)]
    shared = bpe.share_vocabulary(spark, queries.word_vocabulary())
    packed = packing.pack_documents(documents(spark, rows), shared, length=128, with_ids=True).cache()
    want = Counter()
    for doc_id, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 128)):
            piece = ids[at : at + 128]
            want[doc_id, k, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(int)
    for r in sorted(got, key=lambda r: r.offset):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 128
    least = -(-sum(filled.values()) // 128)
    assert least <= len(filled) <= least * 1.05 + 2 * 8
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert {k: len(v) for k, v in whole.items()} == dict(filled)
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in got)


def test_empty_packing(spark):
    shared = bpe.share_vocabulary(spark, queries.word_vocabulary())
    assert packing.pack_documents(documents(spark, []), shared).count() == 0
