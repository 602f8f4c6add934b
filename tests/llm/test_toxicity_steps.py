"""Steps of the toxicity model against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tables import prose

from pulsegrid.llm import toxicity
from pyspark.sql import functions as F


def test_shouts_are_counted_in_every_text():
    rng = random.Random(1)
    pattern = re.compile(r"!!|\b[A-Z]{4,}\b")
    texts = ["STOP THIS NOISE AGAIN and more", "É ÉSTOP STOPÉ _STOP STOP_ STOP9 (STOP) !!!!", "", "AB!!CD", "LOUD" * 3]
    texts += ["".join(rng.choice("ABCDx É_9!. ") for _ in range(rng.randrange(60))) for _ in range(500)]
    for text in texts:
        assert toxicity.count_shouts(text) == len(pattern.findall(text)), repr(text)
    model = toxicity.ToxicityModel({"w": 0})
    assert model.look("STOP THIS NOISE AGAIN " * 10 + "quiet")[1][3] == 1.0


def test_no_known_id_is_lost(spark):
    texts = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    known = spark.range(7, 5000, 50).select(F.col("id").alias("doc_id"))
    kept = {r.doc_id for r in toxicity.with_known_ids(texts, known).collect()}
    assert set(range(7, 5000, 50)) <= kept and len(kept) < 1000
    assert toxicity.with_known_ids(texts, known.where("doc_id < 0")).count() < 100


def test_near_copies_are_one_family(spark):
    rng = random.Random(3)
    texts = [prose(rng, 200, 5000) for _ in range(30)]
    near = [t.rsplit(" ", 3)[0].upper() for t in texts]
    rows = [(i, t) for i, t in enumerate(texts + near + ["", "one", "ONE", "one two"])]
    found = {r.doc_id: r.family for r in toxicity.text_families(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[i] == found[i + 30] for i in range(30)) >= 26
    assert len({found[i] for i in range(30)}) == 30
    assert found[61] == found[62] != found[63] and found[60] == 0


def test_term_evidence_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_EVIDENCE", 3.0)
    monkeypatch.setattr(toxicity, "MIN_LOG_ODDS", 1.0)
    rng = random.Random(5)
    words = [f"{a}{b}word" for a in "abcde" for b in "vwxyz"]
    rows = []
    for i in range(120):
        toxic = i % 3 == 0
        text = " ".join(rng.choice(words[:8] if toxic and rng.random() < 0.4 else words) for _ in range(6))
        rows.append((text, int(toxic), 1))
    rows += [(rows[0][0], 1, 4)] * 4
    found = toxicity.build_lexicon(spark.createDataFrame(rows, "text string, toxic int, copies int"))
    counts, sizes = {0: Counter(), 1: Counter()}, Counter()
    for text, toxic, copies in rows:
        sizes[toxic] += 1 / copies
        for term in toxicity.terms_of(set(text.split())):
            counts[toxic][term] += 1 / copies
    sizes = {k: round(v) for k, v in sizes.items()}
    rate, want = sizes[1] / (sizes[0] + sizes[1]), {}
    for term in counts[1]:
        a, b = round(counts[1][term]), round(counts[0][term])
        if a < toxicity.MIN_TEXTS:
            continue
        odds = math.log((a + 0.5) / (sizes[1] + 1)) - math.log((b + 0.5) / (sizes[0] + 1))
        evidence = a * math.log(a / ((a + b) * rate)) + (b * math.log(b / ((a + b) * (1 - rate))) if b else 0)
        if odds >= 1.0 and evidence >= 3.0:
            want[term] = evidence
    assert len(want) > 2
    assert found == sorted(want, key=lambda t: (-round(want[t], 9), t))


def test_one_round_of_the_label_model(spark):
    rng = random.Random(7)
    votes = [(sum(1 << v for v in range(toxicity.VOTERS) if rng.random() < 0.2), rng.choice([-1, -1, 0, 1]), rng.randrange(1, 9)) for _ in range(60)]
    df = spark.createDataFrame(votes, "mask long, label int, n long").repartition(5)
    n_voters, share = toxicity.VOTERS, 0.25
    model = {
        "fire": np.clip(np.random.default_rng(0).random((2, n_voters)), 0.05, 0.95), "trust": np.linspace(0.3, 1.0, n_voters),
        "gold": np.array([0.9, 0.05]), "prior": np.array([0.2]),
    }
    total = np.zeros((2, n_voters + 3, n_voters + 3))
    for mask, label, n in votes:
        logit = math.log(0.2 / 0.8)
        for v in range(n_voters):
            if mask >> v & 1:
                logit += model["trust"][v] * math.log(model["fire"][0][v] / model["fire"][1][v])
        logit += {1: math.log(0.9 / 0.05), 0: math.log(0.1 / 0.95), -1: 0.0}[label]
        p = 1 / (1 + math.exp(-logit))
        x = np.array([mask >> v & 1 for v in range(n_voters)] + [label == 1, label >= 0, 1], float)
        for c, weight in enumerate((p, 1 - p)):
            total[c] += n * (share if label < 0 else 1) * weight * np.outer(x, x)
    found = toxicity._moments(df, model, share)
    assert np.allclose(found, total)
    rates = toxicity._shares(found)
    size = total[:, -1, -1]
    assert np.allclose(rates["fire"], np.clip((total[:, -1, :n_voters] + 0.5) / (size[:, None] + 1), 1e-4, 1 - 1e-4))
    assert rates["prior"][0] == pytest.approx(size[0] / size.sum())


def test_unlabelled_texts_weigh_a_share_of_the_labelled():
    assert toxicity._share_of_unlabelled(100, 1000) == pytest.approx(toxicity.UNLABELLED * 0.1)
    assert toxicity._share_of_unlabelled(100, 1) == 1.0 and toxicity._share_of_unlabelled(0, 0) == 1.0
