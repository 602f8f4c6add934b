"""Exact inner-product search: the best items of every user, and the ranks of given items.

Items are numbered by falling length and cut into chunks of a fixed number. All users meet one chunk
after another, in tasks; by Cauchy and Schwarz no later item scores above the user's length times that
of the chunk's first item, so a user is done as soon as the worst score that still matters is above it.
Chunks are all that travels to the tasks, a bounded number of bytes a round, after which the users are
written; what a task holds is the chunks of a round, a block of users and their products with a part of a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.ml.blocks import Block
from pulsegrid.operators.partitions import row_index
from pulsegrid.session import drop_folder, work_path, written

CHUNK_ITEMS = 65_536
PART_ITEMS = 4096
USER_ROWS = 256
#: Bytes of chunks that the users meet in one round, held by each task.
ROUND_BYTES = 192 << 20
#: Asked items in a row of the rank search.
PAIR_ROWS = 1024
#: Up to so many asked items are counted by rough products.
FEW = 128
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Users whose rough products are put in order together, within a cache.
GROUP = 16
#: Rounding of a product must not end a search too early.
SLACK = 1 + 1e-9

_STATE = "user bigint, vector array<double>, done boolean, ids array<bigint>, scores array<double>"
_RANKS = "user bigint, vector array<double>, done boolean, asker array<double>, products array<bigint>, names array<bigint>, scores array<double>, above array<bigint>"


def numbered_items(items: DataFrame, id_col: str = "id", vector: str = "features") -> DataFrame:
    """``product``, ``vector`` and ``pos``, the place by falling length."""
    rows = items.select(F.col(id_col).cast("long").alias("product"), F.col(vector).cast("array<double>").alias("vector"))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    placed = row_index(rows.withColumn("less", -length), ["less", "product"], "pos").drop("less")
    return written(placed.withColumn("chunk", F.floor(F.col("pos") / CHUNK_ITEMS)).repartitionByRange("chunk"), "items")


def _chunks(items: DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First place, ids, vectors and lengths of one chunk after another; vectors in single precision where that is all they have."""
    number = 0
    while True:
        rows = items.filter(F.col("chunk") == number).orderBy("pos").select("product", "vector").toArrow()  # at most CHUNK_ITEMS
        if rows.num_rows == 0:
            return
        column = rows.column("vector").combine_chunks()
        if column.null_count or len(pc.unique(pc.list_value_length(column))) > 1:
            raise ValueError("items need vectors of one width")
        vectors = column.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        lengths = np.linalg.norm(vectors, axis=1)
        with np.errstate(over="ignore"):
            single = vectors.astype(np.float32)
        yield number * CHUNK_ITEMS, rows.column("product").to_numpy(), single if np.array_equal(single, vectors) else vectors, lengths
        number += 1


def _rounds(items: DataFrame, steps: tuple) -> Iterator[list[tuple]]:
    """Visits (step, chunk) by rounds of at most ``ROUND_BYTES``: one step after the other, each over all chunks."""
    share = items.sparkSession.sparkContext.broadcast
    for at, step in enumerate(steps):
        held, size, cut = [], 0, False
        for chunk in _chunks(items):
            if held and size + chunk[2].nbytes > ROUND_BYTES:
                yield [(step, c) for c in held]
                held, size, cut = [], 0, True
            held.append(share(chunk))
            size += chunk[2].nbytes
        if not cut:  # all chunks are at hand for the steps to come
            yield [(s, c) for s in steps[at:] for c in held]
            return
        yield [(step, c) for c in held]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, USER_ROWS):
            part = batch.slice(at, USER_ROWS)
            yield part, Block(part.column("vector"), width).dense


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of one block of rows, so that a task never holds the arrays of many."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(USER_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _search(state: DataFrame, items: DataFrame, schema: str, *steps) -> DataFrame:
    """Let all open rows meet chunk after chunk, in each step; rows that are done stay where they were written."""
    spark, finished, places = state.sparkSession, [], []
    for visits in _rounds(items, steps):

        def visit(batches: Iterator[pa.RecordBatch], visits=visits) -> Iterator[pa.RecordBatch]:
            for step, shared in visits:
                batches = step(batches, *shared.value)
            return batches

        if not visits:
            break
        places.append(work_path(spark, "search"))
        with _small_batches(spark):
            state.mapInArrow(visit, schema).write.option("compression", "zstd").parquet(places[-1])
        for shared in {id(shared): shared for _, shared in visits}.values():
            shared.destroy()
        if len(places) > 1 and finished[-1] is None:  # its open rows have been read, and it has no others
            drop_folder(spark, places[-2])
        found = spark.read.schema(schema).parquet(places[-1])
        finished.append(found.filter("done") if found.filter("done").take(1) else None)
        state = found.filter("not done")
        if not state.take(1):
            break
    return reduce(DataFrame.unionByName, [f for f in finished if f is not None] + [state])


def best_items(users: DataFrame, items: DataFrame, k: int, user_col: str = "id", item_col: str = "id", vector: str = "features") -> DataFrame:
    """``user``, ``rank``, ``product`` and ``score`` of the ``k`` items with the largest products; ties to the smaller id."""
    numbered = numbered_items(items, item_col, vector)
    none = F.array().cast("array<bigint>"), F.array().cast("array<double>")
    state = users.select(
        F.col(user_col).cast("long").alias("user"), F.col(vector).cast("array<double>").alias("vector"), F.lit(False).alias("done"),
        none[0].alias("ids"), none[1].alias("scores"),
    )

    def step(batches: Iterator[pa.RecordBatch], _: int, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part, matrix in _blocks(batches, vectors.shape[1]):
            if pc.all(part.column("done")).as_py():
                yield part
                continue
            reach = np.linalg.norm(matrix, axis=1) * SLACK
            best = [(np.array(i, np.int64), np.array(s, float)) for i, s in zip(part.column("ids").to_pylist(), part.column("scores").to_pylist())]
            worst = np.array([s[-1] if len(s) == k else -np.inf for _, s in best])
            for at in range(0, len(ids), PART_ITEMS):
                open_ = np.flatnonzero(reach * lengths[at] >= worst)
                if not len(open_):
                    break
                scores = matrix[open_] @ vectors[at : at + PART_ITEMS].T
                for n in np.flatnonzero(scores.max(axis=1) >= worst[open_]):
                    row, u = scores[n], open_[n]
                    near = np.flatnonzero(row >= worst[u])
                    if len(near) > 4 * k:  # the k-th largest first, then all that reach it
                        near = near[row[near] >= np.partition(row[near], len(near) - k)[len(near) - k]]
                    all_ids, all_scores = np.append(best[u][0], ids[at + near]), np.append(best[u][1], row[near])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    best[u] = all_ids[order], all_scores[order]
                    worst[u] = best[u][1][-1] if len(order) == k else -np.inf
            done = worst > reach * lengths[-1]
            columns = [part.column("user"), part.column("vector"), pa.array(done)]
            columns += [pa.array([b[0] for b in best], pa.list_(pa.int64())), pa.array([b[1] for b in best], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["user", "vector", "done", "ids", "scores"])

    found = _search(state, numbered, _STATE, step)
    flat = found.select("user", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "s"))
    return flat.select("user", (F.col("at") + 1).alias("rank"), F.col("s.ids").alias("product"), F.col("s.scores").alias("score"))


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of vectors given axis by axis, always added in the same order: equal vectors have equal products."""
    total = np.zeros(np.broadcast_shapes(left.shape[1:], right.shape[1:]))
    for a, b in zip(left, right):
        total += a * b.astype(float, copy=False)
    return total


def _few_above(
    asked: list[tuple[np.ndarray, np.ndarray]], vectors: np.ndarray, bounds: np.ndarray, ids: np.ndarray, axes: np.ndarray, rough_axes: np.ndarray
) -> list[np.ndarray]:
    """How many items are above each of the few asked scores and names of some users, whose products are within ``bounds``.

    Rough products as whole numbers, with the place of the item in their low bits, are put in order; items whose
    number is too near to that of an asked score are multiplied anew. ``axes`` are the items axis by axis.
    """
    count, bits = len(ids), max(1, (len(ids) - 1).bit_length())
    top = 1 << (31 - bits)
    scale = (top - 16) / bounds
    slack = 1 + (len(axes) + 4) * top * 2.0**-24  # cut off, and the rounding of all terms
    keys = ((vectors * scale[:, None]).astype(np.float32) @ rough_axes).astype(np.int32)
    keys <<= bits
    keys |= np.arange(count, dtype=np.int32)
    keys.sort(axis=1)
    cuts = np.append(0, np.cumsum([len(scores) for scores, _ in asked]))
    scores, names = np.concatenate([a for a, _ in asked]), np.concatenate([n for _, n in asked])
    user = np.repeat(np.arange(len(asked)), np.diff(cuts))
    place = np.clip(scores * scale[user], 16 - top, top - 16)
    limits = np.stack((np.ceil(np.maximum(place - slack, 8 - top)), np.floor(np.minimum(place + slack, top - 8)) + 1)).astype(np.int32) << bits
    found = np.concatenate([np.searchsorted(row, limits[:, low:high].ravel()).reshape(2, -1) for row, low, high in zip(keys, cuts, cuts[1:])], axis=1)
    near = found[1] - found[0]
    which = np.repeat(np.arange(len(near)), near)
    item = keys[user[which], np.arange(len(which)) - np.repeat(np.cumsum(near) - found[1], near)] & ((1 << bits) - 1)
    exact = _exact(vectors.T[:, user[which]], axes[:, item])
    over = (exact > scores[which]) | ((exact == scores[which]) & (ids[item] < names[which]))
    return np.split(count - found[1] + np.bincount(which[over], minlength=len(near)), cuts[1:-1])


def _items_above(keys: np.ndarray, names: np.ndarray, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How many items, by their negative scores ``row`` and their ids, are above each of the asked keys and names."""
    values = np.sort(row)
    above = np.searchsorted(values, keys, "left")
    tied = values[np.minimum(above, len(values) - 1)] == keys
    if tied.any():
        equal = np.isin(row, keys[tied])
        k, n = np.append(keys[tied], row[equal]), np.append(names[tied], ids[equal])
        item = np.arange(len(k)) >= tied.sum()
        order = np.lexsort((item, n, k))
        before = np.empty(len(k), np.int64)
        before[order] = np.cumsum(item[order])
        above[tied] += before[: tied.sum()] - np.searchsorted(np.sort(row[equal]), keys[tied], "left")
    return above


def _measure(batches: Iterator[pa.RecordBatch], _: int, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Names and scores of the asked items that are in one chunk."""
    order = np.argsort(ids, kind="stable")
    sorted_ids, axes = ids[order], np.ascontiguousarray(vectors.T)
    for part, _ in _blocks(batches, vectors.shape[1]):
        askers, asked = Block(part.column("asker"), vectors.shape[1]).dense, part.column("products")
        wanted, row = asked.flatten().to_numpy(), np.repeat(np.arange(len(part)), pc.list_value_length(asked).to_numpy())
        low = np.searchsorted(sorted_ids, wanted, "left")
        copies = np.searchsorted(sorted_ids, wanted, "right") - low
        row, item = np.repeat(row, copies), np.repeat(low + copies - np.cumsum(copies), copies) + np.arange(copies.sum())
        item = order[item]
        scores = np.zeros(len(row))
        for k, axis in enumerate(axes):
            scores += askers[row, k] * axis[item].astype(float, copy=False)
        known = np.repeat(np.arange(len(part)), pc.list_value_length(part.column("names")).to_numpy())
        place = np.argsort(np.append(known, row), kind="stable")
        names = np.append(part.column("names").flatten().to_numpy(), np.repeat(wanted, copies))[place]
        scores = np.append(part.column("scores").flatten().to_numpy(), scores)[place]
        ends = pa.array(np.append(0, np.cumsum(np.bincount(np.append(known, row), minlength=len(part)))), pa.int32())
        columns = [part.column(c) for c in ("user", "vector", "done", "asker", "products")]
        for values in (pa.array(names, pa.int64()), pa.array(scores, pa.float64()), pa.array(np.zeros(len(names), np.int64))):
            columns.append(pa.ListArray.from_arrays(ends, values))
        yield pa.RecordBatch.from_arrays(columns, names=["user", "vector", "done", "asker", "products", "names", "scores", "above"])


def _count(
    size: int, most: int, batches: Iterator[pa.RecordBatch], _: int, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Items of one chunk above the measured ones, by parts of ``size``: up to ``most`` asked scores are held
    against rough products in order, more against exact ones."""
    for part, matrix in _blocks(batches, vectors.shape[1]):
        if pc.all(part.column("done")).as_py():
            yield part
            continue
        named = part.column("user").to_numpy()
        new = (named[1:] != named[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        heads = np.flatnonzero(np.append(True, new))  # rows of one user lie side by side
        ends = np.cumsum(pc.list_value_length(part.column("names")).to_numpy())
        cuts = np.append(ends[heads[1:] - 1], ends[-1])
        names, scores, above = (part.column(c).flatten().to_numpy() for c in ("names", "scores", "above"))
        above = above.copy()
        asked = [low + np.lexsort((names[low:high], -scores[low:high])) for low, high in zip(np.append(0, cuts[:-1]), cuts)]
        vector, reach = matrix[heads], np.linalg.norm(matrix[heads], axis=1) * SLACK
        lowest = np.array([scores[order[-1]] if len(order) else np.inf for order in asked])
        few = np.array([0 < len(order) <= most for order in asked])
        for at in range(0, len(ids), size):
            open_ = reach * lengths[at] >= lowest
            if not open_.any():
                break
            here, axes = ids[at : at + size], np.ascontiguousarray(vectors[at : at + size].T)
            few &= (1e-15 < reach) & (reach < 1e15) & (1e-15 < lengths[at]) & (lengths[at] < 1e15)  # rough products in single precision
            near, rough_axes = np.flatnonzero(open_ & few), axes.astype(np.float32, copy=False)
            for some in (near[n : n + GROUP] for n in range(0, len(near), GROUP)):
                numbers = _few_above([(scores[asked[u]], names[asked[u]]) for u in some], vector[some], reach[some] * lengths[at], here, axes, rough_axes)
                for u, n in zip(some, numbers):
                    above[asked[u]] += n
            for u in np.flatnonzero(open_ & ~few):
                order = asked[u]
                above[order] += _items_above(-scores[order], names[order], -_exact(vector[u][:, None], axes), here)
        done = np.repeat(lowest > reach * lengths[-1], np.diff(np.append(heads, len(named))))
        nothing = pa.array([None] * len(part), pa.list_(pa.float64())), pa.array([[]] * len(part), pa.list_(pa.int64()))  # all are measured
        columns = [part.column("user"), part.column("vector"), pa.array(done), *nothing, part.column("names"), part.column("scores")]
        columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(above, pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, names=["user", "vector", "done", "asker", "products", "names", "scores", "above"])


def item_ranks(
    users: DataFrame, items: DataFrame, pairs: DataFrame, user_col: str = "id", item_col: str = "id", vector: str = "features", parts: int = 16
) -> DataFrame:
    """``user``, ``product``, ``score`` and ``rank`` of each pair (user, product): its place among all items for that user.

    A rank is one more than the items with a larger product, or an equal one and a smaller id. The asked
    products of a user are cut into rows of at most ``PAIR_ROWS``; up to ``parts`` such rows lie together and
    share their products, so that one user may own very many. Vectors go with rows, not with pairs: the scores
    of the asked products are taken where users and items meet, before any item is counted.
    """
    numbered = numbered_items(items, item_col, vector)
    named = users.select(F.col(user_col).cast("long").alias("user"), F.col(vector).cast("array<double>").alias("vector"))
    owned = pairs.select(F.col("user").cast("long").alias("user"), F.col("product").cast("long").alias("product"))
    place = F.dense_rank().over(Window.partitionBy("user").orderBy("product")) - 1
    cut = owned.withColumn("part", F.floor(place / PAIR_ROWS))
    held = cut.groupBy("user", "part").agg(F.sort_array(F.collect_set("product")).alias("products"))
    asking = held.join(named, "user").join(named.withColumnRenamed("vector", "asker"), "user")
    pieces = 4 * users.sparkSession.sparkContext.defaultParallelism  # of equal work: it goes by rows, not by bytes
    near = asking.repartition(pieces, "user", F.floor(F.col("part") / parts)).sortWithinPartitions("user", "part")
    none = F.array().cast("array<bigint>"), F.array().cast("array<double>")
    state = near.select(
        "user", "vector", F.lit(False).alias("done"), "asker", "products", none[0].alias("names"), none[1].alias("scores"), none[0].alias("above")
    )
    found = _search(state, numbered, _RANKS, _measure, partial(_count, 4 * PART_ITEMS, FEW))
    flat = found.select("user", F.inline(F.arrays_zip("names", "scores", "above")))
    return flat.select("user", F.col("names").alias("product"), F.col("scores").alias("score"), (F.col("above") + 1).alias("rank"))


def whole_ranking_precision(ranks: DataFrame, k: int | None = None) -> DataFrame:
    """Average precision per user from the ranks of all products owned: over the whole ranking, or its first ``k``.

    Only the ranks that count meet in a window; the products owned are counted without it.
    """
    counted = ranks if k is None else ranks.filter(F.col("rank") <= k)
    upto = F.row_number().over(Window.partitionBy("user").orderBy("rank"))
    parts = counted.select("user", "rank").withColumn("upto", upto).groupBy("user").agg(F.sum(F.col("upto") / F.col("rank")).alias("part"), F.count("*").alias("n"))
    if k is None:
        return parts.select("user", (F.col("part") / F.col("n")).alias("average_precision"), F.col("n").alias("owned"))
    sizes = ranks.groupBy("user").agg(F.lit(0.0).alias("part"), F.count("*").alias("n"))
    both = sizes.unionByName(parts.select("user", "part", F.lit(0).cast("long").alias("n"))).groupBy("user").agg(F.sum("part").alias("part"), F.sum("n").alias("owned"))
    return both.select("user", (F.col("part") / F.least("owned", F.lit(k))).alias("average_precision"), "owned")
