"""Language by nearest centroid over TF-IDF letter n-grams.

A text is a vector of hashed three-byte grams of its letters, word edges included, weighted by
``log(1 + count) * idf`` and scaled to length 1. Document frequencies come from all learning rows. The
vectors of a bounded sample of ``FIT_ROWS`` rows per language are clustered by cosine (spherical
k-means) into ``CLUSTERS`` centroids, since one language is written in several ways. A text gets the
language of the closest centroid; it is ``accepted`` if it is not further away than nearly all sampled
members of that centroid.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches, stored
from pulsegrid.llm.words import LOWER, text_bytes, text_slices

DIMS = 4096
CLUSTERS = 4
FIT_ROWS = 1000
ROUNDS = 8
#: Share of a centroid's sampled members that may be further away than its limit.
TAIL = 0.01
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
MAX_TEXTS = 512
SEGMENT = 4 << 20

_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def _add_grams(counts: np.ndarray, data: np.ndarray, owner: np.ndarray) -> None:
    """Count the grams of folded bytes; those with a blank in the middle or two at an edge say nothing."""
    a, b, c = data[:-2], data[1:-1], data[2:]
    at = np.flatnonzero((b != 0x20) & ((a != 0x20) | (c != 0x20)))
    code = a[at].astype(np.uint32) << np.uint32(16) | b[at].astype(np.uint32) << np.uint32(8) | c[at]
    slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
    counts += np.bincount(owner[at] * DIMS + slot, minlength=counts.size).reshape(counts.shape)


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Gram counts per text, one row each; a long text is counted in segments."""
    n = len(offsets) - 1
    counts = np.zeros((n, DIMS), np.int64)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, "right")) - 1)
        size = int(offsets[last] - offsets[first])
        if last == first + 1 and size > SEGMENT:
            for at in range(0, size, SEGMENT):
                low = offsets[first] + at
                part = _FOLD[data[max(low - 2, offsets[first]) : min(low + SEGMENT, offsets[last])]]
                if at == 0:
                    part = np.concatenate(([0x20], part)).astype(np.uint8)
                if at + SEGMENT >= size:
                    part = np.concatenate((part, [0x20])).astype(np.uint8)
                _add_grams(counts[first:last], part, np.zeros(len(part), np.int64))
        else:
            lengths = np.diff(offsets[first : last + 1])
            owner = np.repeat(np.arange(last - first), lengths + 1)
            blank = np.full(size + last - first + 1, 0x20, np.uint8)  # a blank before each text and at the end
            blank[np.arange(size) + np.repeat(np.arange(last - first), lengths) + 1] = _FOLD[data[offsets[first] : offsets[last]]]
            _add_grams(counts[first:last], blank, np.append(owner, last - first - 1))
        first = last
    return counts


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        for at in range(0, part.num_rows, MAX_TEXTS):
            yield part.slice(at, MAX_TEXTS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per task: texts, and texts per gram."""
    texts, having = 0, np.zeros(DIMS, np.int64)
    for part in _slices(batches):
        counts = gram_counts(*text_bytes(part.column("text")))
        texts += len(counts)
        having += (counts > 0).sum(0)
    if texts:
        yield pa.RecordBatch.from_pydict({"texts": pa.array([texts], pa.int64()), "having": pa.array([having.tolist()], pa.list_(pa.int64()))})


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(gram_counts(data, offsets)).astype(np.float32) * idf
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(length > 0, length, 1)


def cluster(points: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: centroids and the lowest cosine each accepts."""
    centre = points.mean(0)
    seeds = [int(np.argmax(points @ centre))]
    nearest = points @ points[seeds[0]]
    while len(seeds) < min(k, len(points)):
        # the text closest to the tenth that the seeds cover worst, so that one odd text is no seed
        seeds.append(int(np.argsort(nearest, kind="stable")[len(points) // 10]))
        nearest = np.maximum(nearest, points @ points[seeds[-1]])
    centroids = points[seeds]
    for _ in range(rounds):
        member = np.argmax(points @ centroids.T, axis=1)
        sums = np.stack([points[member == j].sum(0) if (member == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    closeness = points @ centroids.T
    member = np.argmax(closeness, axis=1)
    limits = [float(np.quantile(closeness[member == j, j], TAIL)) if (member == j).any() else 0.0 for j in range(len(centroids))]
    return centroids.astype(np.float32), np.array(limits)


class LanguageModel:
    """IDF weights, and per centroid its language, vector and limit. A few MB, whatever the corpus."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, limits: np.ndarray) -> None:
        self.idf, self.langs, self.centroids, self.limits = idf, langs, centroids, limits

    def predict(self, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        points = vectors(*text_bytes(column), self.idf)
        has_letter = [t is not None and LETTER.search(t) is not None for t in column.to_pylist()]
        if not len(self.langs):
            return [UNKNOWN] * len(points), [0.0] * len(points), [False] * len(points)
        close = points @ self.centroids.T
        best = np.argmax(close, axis=1)
        score = np.clip(close[np.arange(len(points)), best], 0, 1)
        lang = [self.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter)]
        accepted = (score >= self.limits[best]) & np.array(has_letter, bool)
        return lang, [float(s) if ok else 0.0 for s, ok in zip(score, has_letter)], accepted.tolist()


def _fit_group(key: tuple, table: pa.Table, idf: np.ndarray, clusters: int) -> pa.Table:
    parts = [vectors(*text_bytes(b.column("text")), idf) for b in _slices(iter(table.combine_chunks().to_batches()))]
    centroids, limits = cluster(np.concatenate(parts), clusters)
    rows = [{"lang": key[0].as_py(), "centroid": c.tobytes(), "least": float(x)} for c, x in zip(centroids, limits)]
    return pa.Table.from_pylist(rows, pa.schema([("lang", pa.string()), ("centroid", pa.binary()), ("least", pa.float64())]))


def fit_languages(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", clusters: int = CLUSTERS, fit_rows: int = FIT_ROWS
) -> LanguageModel:
    """Learn from the rows where ``learn`` holds and the language is not null. ``fit_rows`` bounds the sample per
    language (rows with the lowest hash of id and text); document frequencies cover all learning rows."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit(5), F.col(id_col), F.col(text_col)).alias("place"))
    sums = map_batches(rows.select("text"), _frequencies, "texts long, having array<long>")
    sums = stored(sums, "frequencies")
    total = sums.agg(F.sum("texts")).first()[0] or 0
    having = np.zeros(DIMS)
    for at, n in sums.select(F.posexplode("having").alias("at", "n")).groupBy("at").agg(F.sum("n")).collect():  # DIMS rows
        having[at] = n
    idf = (np.log((1 + total) / (1 + having)) + 1).astype(np.float32)

    # stored, so that the planner sees a small table and does not shuffle the texts to join it
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("of")), "languages")
    share = F.lit(float(fit_rows)) / F.col("of") * F.lit(float(1 << 62))
    sample = rows.join(counts, "lang").where(F.shiftrightunsigned("place", 2).cast("double") < share)
    fitted = sample.select("lang", "text").groupBy("lang").applyInArrow(
        lambda key, table: _fit_group(key, table, idf, clusters), "lang string, centroid binary, least double"
    )
    found = fitted.orderBy("lang", "centroid").collect()
    vectors_ = np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]) if found else np.zeros((0, DIMS), np.float32)
    return LanguageModel(idf, [r["lang"] for r in found], vectors_, np.array([r["least"] for r in found]))


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` (cosine to the centroid, 0 to 1) and ``accepted``.

    A null text or one without a letter is ``und`` with score 0, as is everything if nothing was learnt.
    A text beyond the limit of its centroid keeps the closest language but is not ``accepted``. Ties go to the
    first language; repeated rows and null ids pass through; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            lang, score, accepted = shared.value.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
