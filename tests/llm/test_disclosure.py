"""Disclosing terms against a plain count over a small corpus."""

import math
import random
import re
from collections import defaultdict

import pytest
from tables import documents

from pulsegrid.llm import pii

WORD = re.compile("[a-z]{%d,}" % pii.MIN_TERM)
MAIL = re.compile("[a-z]+@[a-z]+[.]org")


def plain_marks(texts, generalise, remove):
    """Per text its marked words, by counting every pair of entity and word."""
    different = sorted(set(texts))
    words = {t: set(WORD.findall(MAIL.sub(" ", t))) for t in different}
    every = {t: set(WORD.findall(t)) for t in different}
    entities = {t: set(MAIL.findall(t)) for t in different}
    n, holders, with_term = len(different), defaultdict(set), defaultdict(set)
    for t in different:
        for e in entities[t]:
            holders[e].add(t)
        for w in every[t]:
            with_term[w].add(t)
    beyond, own = set(), defaultdict(set)
    for e, held in holders.items():
        information = math.log2(n / len(held))
        for w in set().union(*(words[t] for t in held)):
            both = sum(w in words[t] for t in held)
            share = (both - 1 / 3) / (len(with_term[w]) + 1 / 3)
            if information <= 0 or (information + math.log2(share)) / information < min(generalise, remove) or share < pii.WITHIN:
                continue
            if share >= pii.BEYOND:
                beyond.add(w)
            for t in held:
                own[t].add(w)
    return {t: sorted(w for w in WORD.findall(MAIL.sub(" ", t)) if w in beyond or w in own[t]) for t in different}


@pytest.mark.parametrize("seed, generalise, remove", [(1, 0.7, 0.95), (2, 0.4, 0.8), (3, 0.8, 0.99)])
def test_marks_equal_a_count_of_all_pairs(spark, seed, generalise, remove):
    rng = random.Random(seed)
    name = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    vocabulary, mails = [name(rng.randrange(1, 6)) for _ in range(150)], [f"{name(4)}@{name(5)}.org" for _ in range(9)]
    texts = [" ".join(rng.choices(vocabulary, k=12) + rng.choices(mails, k=rng.choice([0, 0, 1, 2]))) for _ in range(90)]
    texts += [f"{texts[0]} li wu {mails[0]}"] * 3 + texts[:5]
    want = plain_marks(texts, generalise, remove)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = pii.find_personal_data(documents(spark, rows), generalise=generalise, remove=remove).collect()
    for r in found:
        text = texts[r.doc_id]
        assert sorted(text[t["start"] : t["end"]] for t in r.terms) == want[text], text
    assert any(want.values())


def test_rare_words_elsewhere_stay(spark):
    """The share of texts without an entity that are marked does not grow with the corpus."""
    rng = random.Random(9)
    for size in (200, 1500):
        rows = [(i, " ".join(f"w{rng.randrange(4 * size):x}z" for _ in range(25)) + (f" k{i}@x.org" if i % 10 == 0 else ""), "en", "s") for i in range(size)]
        rows = [(i, t.translate(str.maketrans("0123456789", "ghijklmnop")), a, b) for i, t, a, b in rows]
        found = pii.find_personal_data(documents(spark, rows)).collect()
        marked = [r for r in found if r.terms and not r.spans]
        assert len(marked) <= 0.02 * size


def test_sanitise_odd_rows(spark):
    rows = [(1, None, None, None), (None, "a jo@x.org", "en", "s"), (2, "", "en", "s"), (2, "", "en", "s"), (3, "b jo@x.org", "en", "s")]
    clean = sorted(((r.doc_id or 0), r.text) for r in pii.sanitise(documents(spark, rows)).collect())
    assert clean == [(0, "a [email]"), (1, ""), (2, ""), (2, ""), (3, "b [email]")]
    assert pii.sanitise(documents(spark, [])).count() == 0
