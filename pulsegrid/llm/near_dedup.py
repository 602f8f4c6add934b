"""Near duplicates: SuperMinHash signatures, banding, verification on full shingle sets, union-find.

1. *Classes.* Each text becomes the set of its distinct word shingles (64-bit hashes). Texts with equal
   sets form one class, however many there are; from here on only classes count.
2. *Signatures.* SuperMinHash gives slot j of a signature the least value ``i + r`` over all elements,
   where an element visits the slots in a random order of its own; the ranks within one element are
   correlated, which lowers the variance. An element stops as soon as no slot can improve.
3. *Bands.* ``ROWS`` slots make a band. The number of bands follows from the similarity asked for and
   from ``MISS``, the chance that a pair exactly at it shares no band.
4. *Stars.* In every bucket all members are verified against one hub, the member that meets most
   others. Most buckets end in one component after that.
5. *Rest.* In buckets where other members are still in different components, those pairs are tested
   inside tasks, block against block, and skipped once their components have met. Only links that
   join two components leave the task, so a group never emits its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.components import components
from pulsegrid.llm.frames import keyed_texts, map_batches, packed, stored
from pulsegrid.llm.words import LOWER, find_words, hash_windows, hash_words, mix64, text_bytes, text_slices

ROWS = 5
MISS = 1e-7
SALTS = 256
#: Elements of the sets that a block of a crowded bucket holds.
BLOCK_ELEMENTS = 1 << 19
#: Text that a task signs at a time; an unfilled signature keeps a permutation of all slots per element.
SLICE_BYTES = 1 << 20
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def band_count(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))) if percent < 100 else 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, without words none."""
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets)
    words = hash_words(data, starts, ends)
    windows = hash_windows(words, width)
    sets = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= width:
            sets.append(np.unique(windows[a : z - width + 1]))
        else:
            sets.append(hash_windows(words[a:z], z - a) if z > a else words[:0])
    return sets


def superminhash(x: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """Signatures, one row per set; ``x`` holds the elements of all sets one after the other."""
    n = len(counts)
    best = np.full(n * slots, np.inf)
    owner = np.repeat(np.arange(n), counts)
    order = None  # what is left of each element's permutation
    for step in range(slots):
        draw = mix64(x + _U((step + 1) * _STEP % 2**64))
        pick = step + (((draw & _U(0xFFFFFFFF)) * _U(slots - step)) >> _U(32)).astype(np.int64)
        target = pick
        if order is not None:
            row = np.arange(len(x))
            target = order[row, pick].astype(np.int64)
            order[row, pick] = order[row, step]
        np.minimum.at(best, owner * slots + target, step + (draw >> _U(32)) * 2.0**-32)
        unfilled = np.isinf(best.reshape(n, slots)).any(1)
        more = unfilled[owner]
        if not more.any():
            break
        x, owner = x[more], owner[more]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16 if slots > 256 else np.uint8), (len(x), 1))
            order[np.arange(len(x)), pick[more]] = 0
        else:
            order = order[more]
    return best.reshape(n, slots)


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different for equal slots of different bands."""
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), -1, rows)
    keys = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64) * _U(_STEP), bits.shape[:2])
    for i in range(rows):
        keys = mix64(keys ^ bits[:, :, i])
    return keys


def _signer(width: int, bands: int):
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("sid", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(*text_bytes(part.column("text")), width)
            counts = np.array([len(s) for s in sets])
            some = np.flatnonzero(counts)
            ids: list[bytes | None] = [None] * len(sets)
            ends = np.concatenate(([0], np.cumsum((counts > 0) * bands)))
            flat = np.zeros(0, np.int64)
            if len(some):
                x = np.concatenate([sets[i] for i in some])
                starts = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
                one, two = (np.add.reduceat(mix64(x ^ _U(c)), starts) for c in (0x51ED270B4A1C9C35, 0xC2B2AE3D27D4EB4F))
                for i, a, b in zip(some.tolist(), one.tolist(), two.tolist()):
                    ids[i] = (a << 64 | b).to_bytes(16, "big")
                flat = band_keys(superminhash(x, counts[some], bands * ROWS)).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            columns = [part.column("doc_id"), part.column("th"), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            sets = [s.tobytes() for s in shingle_sets(*text_bytes(part.column("text")), width)]
            yield pa.RecordBatch.from_arrays([part.column("sid"), pa.array(sets, pa.binary())], names=["sid", "elements"])

    return run


def common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    at = np.searchsorted(right, left)
    return int((right[np.minimum(at, len(right) - 1)] == left).sum())


def _star_tester(percent: int):
    """Rows sorted by hub, salt and role, the hub first; out: the members that are linked with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for name, sid, member, elements in zip(*[batch.column(c) for c in ("hub", "sid", "member", "elements")]):
                own = np.frombuffer(elements.as_buffer(), np.uint64)
                if not member.as_py():
                    hub, base = name.as_py(), own.copy()
                    continue
                if name.as_py() != hub:
                    raise ValueError("a hub is missing before its members")
                both = common(base, own)
                if 100 * both >= percent * (len(base) + len(own) - both):
                    a.append(hub)
                    b.append(sid.as_py())
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def link_members(members: list[tuple[bytes, bytes, int]], sets: list[np.ndarray], percent: int, inner: bool) -> list[tuple[bytes, bytes]]:
    """Links that join components. ``members``: id, component and side (0 or 1) of each set.

    All pairs of different components are decided on full sets, those of equal sides only if ``inner``.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    members, sets = [members[i] for i in order], [sets[i] for i in order]
    counts = np.array([len(s) for s in sets])
    vocabulary, flat, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), counts)
    shared = often[flat] > 1  # an element of one set only is in no intersection
    flat, owner = flat[shared], owner[shared]
    starts = np.searchsorted(owner, np.arange(len(sets) + 1))
    label = np.unique(np.array([int.from_bytes(c[:8], "big") ^ int.from_bytes(c[8:], "big") for _, c, _ in members], np.uint64), return_inverse=True)[1]
    side = np.array([s for _, _, s in members])
    mark = np.zeros(len(vocabulary), bool)
    links = []
    for i in range(len(sets) - 1):
        other = (label[i + 1 :] != label[i]) & (100 * counts[i] >= percent * counts[i + 1 :])
        if not inner:
            other &= side[i + 1 :] != side[i]
        able = np.flatnonzero(other) + i + 1
        if not len(able):
            continue
        mine = flat[starts[i] : starts[i + 1]]
        mark[mine] = True
        low, high = starts[able[0]], starts[able[-1] + 1]
        sums = np.concatenate(([0], np.cumsum(mark[flat[low:high]])))
        both = sums[starts[able + 1] - low] - sums[starts[able] - low]
        mark[mine] = False
        for j in able[100 * both >= percent * (counts[i] + counts[able] - both)]:
            if label[j] != label[i]:
                links.append((members[i][0], members[j][0]))
                label[label == label[j]] = label[i]
    return links


def _block_tester(percent: int):
    """Rows sorted by bucket and block pair; out: links that join components."""

    def decide(key, rows) -> list[tuple[bytes, bytes]]:
        members = [(r[0], r[1], r[2]) for r in rows]
        return link_members(members, [r[3] for r in rows], percent, inner=key[1] == key[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            links = []
            names = ("bucket", "low", "high", "sid", "comp", "block")
            columns = [batch.column(c).to_pylist() for c in names]
            for bucket, low, high, sid, comp, block, elements in zip(*columns, batch.column("elements")):
                if (bucket, low, high) != at:
                    if len(rows) > 1:
                        links += decide(at, rows)
                    at, rows = (bucket, low, high), []
                rows.append((sid, comp, int(block == high), np.frombuffer(elements.as_buffer(), np.uint64).copy()))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])
        links = decide(at, rows) if len(rows) > 1 else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])

    return run


def _bucket_members(classes: DataFrame) -> DataFrame:
    """Members of the buckets with more than one class, with the bucket's number of members and elements."""
    placed = classes.select("sid", "n", F.explode("bands").alias("bucket"))
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("elements")).where("size > 1")
    return stored(placed.join(crowded, "bucket"), "buckets")


def _star_pairs(inside: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Hub of each bucket, and the distinct (hub, member) pairs that sizes do not rule out."""
    meets = inside.groupBy("sid").agg(F.sum("size").alias("meets"))
    hubs = inside.join(meets, "sid").groupBy("bucket").agg(F.max(F.struct("meets", "sid", "n")).alias("top"))
    hubs = stored(hubs.select("bucket", F.col("top.sid").alias("hub"), F.col("top.n").alias("hub_n")), "hubs")
    pairs = inside.join(hubs, "bucket").where("sid != hub")
    fits = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    return hubs, pairs.where(fits).select("hub", "sid").distinct()


def _test_stars(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(SALTS)))
    members = pairs.join(sets, "sid").select("hub", "salt", F.lit(True).alias("member"), "sid", "elements")
    centres = pairs.select("hub", "salt").distinct().join(sets.withColumnRenamed("sid", "hub"), "hub")
    centres = centres.select("hub", "salt", F.lit(False).alias("member"), F.col("hub").alias("sid"), "elements")
    rows = members.unionByName(centres).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return map_batches(rows.select("hub", "sid", "member", "elements"), _star_tester(percent), "a binary, b binary")


def _test_rest(inside: DataFrame, hubs: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Test what the stars left open: members of one bucket, the hub aside, in different components."""
    comps = found.select(F.col("node").alias("sid"), "root")
    rest = inside.join(hubs, "bucket").where("sid != hub and size > 2").drop("hub", "hub_n")
    rest = rest.join(comps, "sid", "left").withColumn("comp", F.coalesce("root", "sid")).drop("root")
    mixed = rest.groupBy("bucket").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2").select("bucket")
    rest = rest.join(mixed, "bucket", "left_semi")
    blocks = F.ceil(F.col("elements") / BLOCK_ELEMENTS)
    rest = rest.withColumn("block", F.pmod(F.xxhash64("sid"), blocks)).select(
        "bucket", "sid", "comp", "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("with")
    )
    rest = rest.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("with")
    rows = rest.join(sets, "sid").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "sid")
    rows = rows.select("bucket", "low", "high", "sid", "comp", "block", "elements")
    return map_batches(rows, _block_tester(percent), "a binary, b binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id``, ``th``, ``n_shingles``, ``component_id``, ``kept``.

    Words are lower-cased in A-Z; a set holds distinct shingles of ``width`` words, the whole sequence
    if there are fewer, nothing for a null, empty or blank text, which is linked with nothing. Two texts
    are linked if ``100 * common >= percent * all`` shingles; ``component_id`` is the smallest id that links
    reach. Rows without an id are linked like others, but never name a component: they are kept only
    where no row of the component has an id. Rows repeating the kept id and text are all marked kept.
    An empty table gives no rows; other columns are not read.
    """
    texts = keyed_texts(docs, id_col, text_col)
    bands = band_count(percent)
    signed = stored(map_batches(texts, _signer(width, bands), "doc_id long, th long, sid binary, n long, bands array<long>"), "signatures")
    classes = signed.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "th")).alias("sample"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
    )
    classes = stored(classes, "classes")
    inside = _bucket_members(classes)
    wanted = classes.select("sid", "sample").join(inside.select("sid").distinct(), "sid", "left_semi")
    wanted = wanted.select("sid", F.col("sample.doc_id").alias("want_id"), F.col("sample.th").alias("want_th"))
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["want_id"]) & (texts["th"] == wanted["want_th"]))
    sets = map_batches(found.select("sid", "text"), _set_maker(width), "sid binary, elements binary")
    sets = stored(sets.groupBy("sid").agg(F.any_value("elements").alias("elements")), "sets")

    hubs, pairs = _star_pairs(inside, percent)
    links = stored(_test_stars(pairs, sets, percent), "stars")
    first = stored(components(links), "components")
    more = stored(_test_rest(inside, hubs, first, sets, percent), "rest")
    if not more.isEmpty():
        # the first components as stars stand for all links found so far
        first = stored(components(first.toDF("a", "b").unionByName(more)), "components")
    rooted = classes.select("sid", "least_id").join(first.withColumnRenamed("node", "sid"), "sid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "sid"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("sid", "component_id")
    rows = signed.select("doc_id", "th", "sid", "n").join(named, "sid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", "th", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one per component of near-equal texts, with all their columns."""
    kept = near_groups(docs, id_col, text_col, **options).where("kept").select("doc_id", "th")
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = packed(docs, F.col(f"`{id_col}`").cast("long").alias("id"), th.alias("text_hash"))
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["text_hash"] == kept["th"])
    return rows.join(kept, same, "left_semi").select("row.*")
