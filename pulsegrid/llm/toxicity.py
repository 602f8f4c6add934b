"""Toxicity by weak supervision.

1. *Voters.* From all labelled rows come words and word beginnings that toxic texts use far
   more often than others. They are dealt out to many lexicon voters; pattern voters look at how many
   such terms a text has, how dense and how varied they are, and at shouting. A voter fires or not.
2. *Label model.* Every text of the corpus is reduced to its set of firing voters. An EM over the counts of
   these sets estimates how often each voter fires on toxic and on other texts, with the given labels
   as one more, fallible voter. A voter that does not fire abstains: a lexicon of one language says nothing
   about a text in another. Correlated voters would count the same evidence twice, so each voter's
   evidence is divided by the excess of its correlations within the classes.
3. *Classifier.* A logistic regression on term and pattern features is trained on the posterior labels of a
   sample of all texts, labelled or not. It scores whole texts; labels, language, source and id are no features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_batches, stored
from pulsegrid.llm.pii import term_bitmap
from pulsegrid.llm.words import LOWER, find_words, hash_windows, hash_words, text_bytes, text_slices

#: Labelled rows, and again rows of all texts, that the classifier is fitted on, at most (in expectation, by hash); the labels
#: of the first are those that the label model sees.
FIT_ROWS = 20_000
#: What all texts without a label count beside all labelled ones, in the label model and in the classifier: there are many
#: more of them, and left to themselves they make "any hit at all" the class.
UNLABELLED = 0.1
MIN_TEXTS = 3
MIN_LOG_ODDS = 3.5
#: Log likelihood ratio against "the term says nothing"; chance alone reaches it in about one of 10**7 terms.
MIN_EVIDENCE = 14.0
BEGINNINGS = (4, 5, 6, 7, 8)
LEXICON_GROUPS = 3
#: Words of the runs by which near copies of a text are told to be one family.
FAMILY_WORDS = 3
ROUNDS = 8
WORD = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile("[A-Z]{4,}")
#: Names of the pattern voters.
PATTERNS = ("two_hits", "four_hits", "dense", "varied", "shouting", "clean", "single")
KINDS = 1 + len(BEGINNINGS)
VOTERS = KINDS * LEXICON_GROUPS + len(PATTERNS)


def terms_of(words: set[str]) -> set[str]:
    """The words and their beginnings (marked by a star)."""
    terms = set(words)
    for n in BEGINNINGS:
        terms.update([w[:n] + "*" for w in words if len(w) > n])
    return terms


def count_shouts(text: str) -> int:
    """Doubled exclamation marks, and words of four or more capitals A-Z, in the whole text."""
    part_of_word = lambda c: c.isalnum() or c == "_"
    found = text.count("!!")
    for m in CAPITALS.finditer(text):
        before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
        found += not (part_of_word(before) or part_of_word(after))
    return found


def _kind(term: str) -> int:
    return BEGINNINGS.index(len(term) - 1) + 1 if term.endswith("*") else 0


@dataclass
class ToxicityModel:
    """Lexicon, classifier weights and what the label model has found about the voters."""

    lexicon: dict[str, int] = field(default_factory=dict)  # term to rank
    weights: np.ndarray | None = None
    bias: float = -6.0
    voters: dict[str, np.ndarray] = field(default_factory=dict)

    def look(self, text: str) -> tuple[list[int], list[float], int]:
        """Ranks of the lexicon terms found, dense features, and the voters that fire as a bit mask."""
        words = WORD.findall(text.lower())
        counts = Counter(words)
        found: dict[str, list[int]] = {}
        lexicon = self.lexicon
        for word in counts:
            ranks = [lexicon[word]] if word in lexicon else []
            for n in BEGINNINGS:
                if len(word) <= n:
                    break
                rank = lexicon.get(word[:n] + "*")
                if rank is not None:
                    ranks.append(rank)
            if ranks:
                found[word] = ranks
        hits = sum(counts[w] for w in found)
        share = hits / max(1, len(words))
        shouts = count_shouts(text)
        mask = 0
        for ranks in found.values():
            for rank in ranks:
                mask |= 1 << (self.kinds[rank] * LEXICON_GROUPS + rank * LEXICON_GROUPS // len(lexicon))
        fired = (hits >= 2, hits >= 4, hits >= 2 and share >= 0.01, len(found) >= 2, shouts > 10, hits == 0, hits == 1)
        for i, yes in enumerate(fired):
            mask |= yes << (KINDS * LEXICON_GROUPS + i)
        dense = [math.log1p(hits), math.log1p(len(found)), min(1.0, 10 * share), float(shouts > 10)]
        return sorted({r for ranks in found.values() for r in ranks}), dense, mask

    @property
    def kinds(self) -> list[int]:
        if not hasattr(self, "_kinds"):
            self._kinds = [_kind(t) for t in self.lexicon]
        return self._kinds

    def score(self, text: str) -> float:
        ranks, dense, _ = self.look(text)
        if self.weights is None:
            return 0.0
        logit = self.bias + float(self.weights[ranks].sum()) + float(np.dot(self.weights[len(self.lexicon) :], dense))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: texts of either label that have a term; a last row without a term counts the texts."""
    for part in text_slices(batches, "text"):
        columns = [part.column(c).to_pylist() for c in ("text", "toxic", "copies")]
        counts, texts = (Counter(), Counter()), [0.0, 0.0]
        for text, label, copies in zip(*columns):
            terms = terms_of(set(WORD.findall(text.lower())))
            if copies == 1:
                counts[label].update(terms)
            else:
                for t in terms:
                    counts[label][t] += 1 / copies
            texts[label] += 1 / copies
        terms = list(counts[0].keys() | counts[1].keys())
        sums = [[float(c[t]) for t in terms] + [n] for c, n in zip(counts, texts)]
        yield pa.RecordBatch.from_arrays([pa.array([*terms, None], pa.string()), *[pa.array(s, pa.float64()) for s in sums]], names=["term", "clean", "toxic"])


def build_lexicon(labelled: DataFrame) -> list[str]:
    """All terms with high odds and enough evidence for toxic, most evidence first; a term must be in ``MIN_TEXTS`` toxic
    texts. Rows of ``text, toxic, copies``; a row counts as one of its copies."""
    counts = map_batches(labelled, _term_counts, "term string, clean double, toxic double")
    counts = counts.groupBy("term").agg(F.round(F.sum("clean")).alias("clean"), F.round(F.sum("toxic")).alias("toxic"))
    # terms in too few toxic texts need not be kept
    counts = stored(counts.where(F.col("term").isNull() | (F.col("toxic") >= MIN_TEXTS)), "terms")
    texts = counts.where("term is null").first()
    if texts is None or not texts["toxic"] or not texts["clean"]:
        return []
    odds = F.log((F.col("toxic") + 0.5) / (texts["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (texts["clean"] + 1.0))
    chosen = counts.where("term is not null")
    both, rate = F.col("toxic") + F.col("clean"), texts["toxic"] / (texts["toxic"] + texts["clean"])
    part = lambda n, share: F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)
    evidence = part(F.col("toxic"), rate) + part(F.col("clean"), 1 - rate)
    chosen = chosen.withColumn("evidence", evidence).where((odds >= MIN_LOG_ODDS) & (F.col("evidence") >= MIN_EVIDENCE))
    return [r["term"] for r in chosen.orderBy(F.desc("evidence"), "term").collect()]


def _voter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per slice: how many texts have each set of firing voters and each label (-1: none)."""
        for part in text_slices(batches, "text"):
            model = shared.value
            counts = Counter(zip([model.look(t)[2] for t in part.column("text").to_pylist()], part.column("toxic").to_pylist()))
            yield pa.RecordBatch.from_pydict(
                {"mask": pa.array([m for m, _ in counts], pa.int64()), "label": pa.array([g for _, g in counts], pa.int32()), "n": pa.array(list(counts.values()), pa.int64())}
            )

    return run


def _bits(mask: np.ndarray) -> np.ndarray:
    return (mask[:, None] >> np.arange(VOTERS) & 1).astype(float)


def _posterior(bits: np.ndarray, label: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Probability of toxic given the voters that fire and, where there is one, the label (else -1)."""
    gold, prior = model["gold"], model["prior"][0]
    logit = math.log(prior / (1 - prior)) + bits @ (np.log(model["fire"][0] / model["fire"][1]) * model["trust"])
    yes, no = math.log(gold[0] / gold[1]), math.log((1 - gold[0]) / (1 - gold[1]))
    logit = logit + np.where(label == 1, yes, np.where(label == 0, no, 0.0))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _share_of_unlabelled(labelled: float, others: float) -> float:
    """What one text without a label counts."""
    return min(1.0, UNLABELLED * labelled / others) if others else 1.0


def _moments(votes: DataFrame, model: dict[str, np.ndarray] | None, unlabelled: float = 0.0) -> np.ndarray:
    """Weighted joint firing counts per class, over all votes: voters, label 1, labelled, and one by each other.

    Without a model the labels are the classes. A text without a label counts ``unlabelled``. The tables of the tasks are summed cell by cell.
    """
    side = VOTERS + 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, side, side))
        for batch in batches:
            mask, label, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "label", "n"))
            bits = _bits(mask)
            p = label.clip(0).astype(float) if model is None else _posterior(bits, label, model)
            n = n * np.where(label >= 0, 1.0, unlabelled)
            x = np.column_stack((bits, label == 1, label >= 0, np.ones(len(n)))).astype(float)
            total += [(x * (n * w)[:, None]).T @ x for w in (p, 1 - p)]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    cells = map_batches(votes, run, "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
    out = np.zeros(2 * side * side)
    for at, x in cells.groupBy("at").agg(F.sum("x")).collect():  # a fixed number of cells
        out[at] = x
    return out.reshape(2, side, side)


def _shares(moments: np.ndarray) -> dict[str, np.ndarray]:
    """Firing rates, label rates and prior from the moments."""
    one = moments[:, -1, -1]
    fire = (moments[:, -1, :VOTERS] + 0.5) / (one[:, None] + 1)
    gold = (moments[:, -1, VOTERS] + 0.5) / (moments[:, -1, VOTERS + 1] + 1)
    prior = np.clip(one[0] / max(1.0, one.sum()), 1e-4, 0.5)
    return {"fire": np.clip(fire, 1e-4, 1 - 1e-4), "gold": np.clip(gold, 1e-3, 1 - 1e-3), "prior": np.array([prior])}


def _trust(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One over one plus the summed positive correlations of a voter with the others inside the classes."""
    total = np.zeros((VOTERS, VOTERS))
    for table in moments:
        size = max(table[-1, -1], 1e-9)
        joint = table[:VOTERS, :VOTERS] / size
        mean = np.diag(joint)
        spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
        total += size * (joint - np.outer(mean, mean)) / np.outer(spread, spread)
    corr = np.clip(total / max(moments[:, -1, -1].sum(), 1e-9), -1, 1)
    np.fill_diagonal(corr, 1)
    return 1 / np.maximum(1.0, np.clip(corr, 0, 1).sum(1)), corr


def fit_label_model(votes: DataFrame, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """EM over ``mask, label, n``: firing rates per class, correlations, trust, label rates and prior.

    Each round is one aggregation to a table of fixed size, whatever the number of texts.
    """
    model = _shares(_moments(votes, None)) | {"trust": np.ones(VOTERS), "gold": np.array([0.95, 0.02])}
    labelled, others = votes.agg(F.sum(F.when(F.col("label") >= 0, F.col("n"))), F.sum(F.when(F.col("label") < 0, F.col("n")))).first()
    share = _share_of_unlabelled(labelled or 0, others or 0)
    for _ in range(rounds):
        moments = _moments(votes, model, share)
        model["trust"], model["correlation"] = _trust(moments)
        model |= _shares(moments)
    return model


def fit_linear(
    rows: list[tuple[list[int], list[float]]], targets: np.ndarray, terms: int, l2: float = 1.0, steps: int = 300, counts: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps over sparse rows; a row counts as much as ``counts`` says."""
    counts = np.ones(len(rows)) if counts is None else counts
    dense = np.array([d for _, d in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    column = np.array([c for r, _ in rows for c in r], np.int64)
    size = terms + dense.shape[1]
    w, bias = np.zeros(size), -2.0
    ahead, ahead_bias, speed = w.copy(), bias, 1.0
    # a row has few features, so its squared length bounds the curvature
    length = np.bincount(owner, minlength=len(rows)) + (dense**2).sum(1) + 1
    rate = 1 / (0.25 * length.mean() * len(rows) + l2)
    for _ in range(steps):
        logit = ahead_bias + np.bincount(owner, ahead[column], minlength=len(rows)) + dense @ ahead[terms:]
        miss = counts * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - targets)
        grad = np.concatenate((np.bincount(column, miss[owner], minlength=terms), dense.T @ miss)) + l2 * ahead
        after, after_bias = ahead - rate * grad, ahead_bias - rate * miss.sum()
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        ahead, ahead_bias = after + (speed - 1) / faster * (after - w), after_bias + (speed - 1) / faster * (after_bias - bias)
        w, bias, speed = after, after_bias, faster
    return w, bias


def with_known_ids(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose ``doc_id`` may be among the known ones, by a bitmap of bounded size: no known id is lost, few others stay."""
    hashed = known.select(F.xxhash64("doc_id").alias("term")).distinct()
    bits, power = term_bitmap(hashed)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("id_hash").to_numpy().view(np.uint64) >> np.uint64(64 - power)
            hit = shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
            yield batch.filter(pa.array(hit)).select(["doc_id", "text"])

    return map_batches(texts.select("doc_id", "text", F.xxhash64("doc_id").alias("id_hash")), run, "doc_id long, text string")


def text_families(texts: DataFrame) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text) and ``family``, the smallest hash of three following words: mostly the same for near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            data = LOWER[data]
            starts, ends, first = find_words(data, offsets)
            hashes = hash_words(data, starts, ends)
            least = np.zeros(part.num_rows, np.uint64)
            for i, (a, b) in enumerate(zip(first, first[1:])):
                if b > a:
                    least[i] = (hash_windows(hashes[a:b], FAMILY_WORDS) if b - a >= FAMILY_WORDS else hashes[a:b]).min()
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(least.view(np.int64))], names=["doc_id", "th", "family"])

    return map_batches(texts.select("doc_id", "text", F.xxhash64("text").alias("th")), run, "doc_id long, th long, family long")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS
) -> ToxicityModel:
    """Fit on ``labels`` (learning rows only). All of them shape the lexicon; ``fit_rows`` bounds those that anchor the
    label model, which is estimated on every text, and the texts of the classifier: as many labelled ones, and as many of all. Null labels and ids are left out; without both labels the model scores 0.
    A label other than 0 counts as 1; if an id is labelled twice the higher label holds."""
    labels = labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
    labels = labels.groupBy(F.col(f"`{id_col}`").cast("long").alias("label_id")).agg((F.max(f"`{label_col}`") != 0).cast("int").alias("toxic"))
    labels = stored(labels, "labels")
    share = min(1.0, fit_rows / max(1, labels.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), "label_id"), 11) / F.lit(float(1 << 53))
    chosen = F.broadcast(labels.where(place < share))  # about ``fit_rows`` rows of 12 bytes
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # texts without a label leave the scan, so that only labelled ones are shuffled, by the same plan at every size
    maybe = with_known_ids(texts, labels.select(F.col("label_id").alias("doc_id")))
    # copies of a text, near ones too, are no more evidence: one id of each family counts, found on hashes alone
    keys = text_families(maybe).join(labels, F.col("doc_id") == F.col("label_id"))
    keys = keys.groupBy("family", "th", "label_id").agg(F.max("toxic").alias("toxic"), F.count("*").alias("copies"))
    keys = keys.groupBy("family").agg(F.min(F.struct("label_id", "th", "toxic", "copies")).alias("k")).select("k.*")
    keys = stored(keys, "texts")
    same = (F.col("doc_id") == F.col("label_id")) & (F.xxhash64("text") == F.col("th"))
    labelled = maybe.join(keys.hint("merge"), same)
    lexicon = build_lexicon(labelled.select("text", "toxic", "copies"))
    sample = texts.join(chosen, F.col("doc_id") == F.col("label_id")).select("text", "toxic")
    share = min(1.0, fit_rows / max(1, docs.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(12), "text"), 11) / F.lit(float(1 << 53))  # copies go together
    others = texts.where(place < share).groupBy("text").agg(F.lit(-1).alias("toxic"))
    sample = stored(sample.unionByName(others).groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")
    model = ToxicityModel({t: i for i, t in enumerate(lexicon)})
    if not lexicon:
        return model

    shared = docs.sparkSession.sparkContext.broadcast(model)
    known = texts.join(chosen, F.col("doc_id") == F.col("label_id"), "left").select("text", F.coalesce("toxic", F.lit(-1)).alias("toxic"))
    votes = map_batches(known, _voter(shared), "mask long, label int, n long")
    votes = stored(votes.groupBy("mask", "label").agg(F.sum("n").alias("n")), "votes")
    model.voters = fit_label_model(votes)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            seen = [shared.value.look(t) for t in part.column("text").to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*seen), (pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, part.column("toxic")], names=["ranks", "dense", "mask", "toxic"])

    rows = map_batches(sample, look, "ranks array<int>, dense array<double>, mask long, toxic int")
    rows = sorted((r["ranks"], r["dense"], r["mask"], r["toxic"]) for r in rows.toLocalIterator())  # about ``fit_rows`` short rows
    given = np.array([r[3] for r in rows])
    targets = _posterior(_bits(np.array([r[2] for r in rows])), given, model.voters)
    counts = np.where(given >= 0, 1.0, _share_of_unlabelled((given >= 0).sum(), (given < 0).sum()))
    model.weights, model.bias = fit_linear([r[:2] for r in rows], targets, len(lexicon), counts=counts)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``score``, 0 to 1. A null text counts as empty. Each row is scored by itself, so
    repeated rows and null ids pass through; an empty table gives no rows; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            scores = [shared.value.score(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, score double")
