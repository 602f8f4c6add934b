"""Operators against plain Python on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from tables import documents, prose
from tokenizers import Tokenizer

from pulsegrid.llm import bpe, exact_dedup, language, mixing, near_dedup, pii, quality, queries, substring_dedup, toxicity, warc, words
from pyspark.sql import functions as F

WORD = re.compile(words.WORD)


def edited(rng, text, changes):
    out = text.split()
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10_000)}"
    return " ".join(out)


# words and hashes


def test_word_hashes_depend_on_the_word_only():
    texts = ["alpha beta\x0bgamma", None, "", "  beta ", "alpha beta gamma", "x" * 5_000_000 + " beta"]
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = words.find_words(data, offsets)
    hashes = words.hash_words(data, starts, ends)
    found = [[data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert found == [WORD.findall(t or "") for t in texts]
    by_word = defaultdict(set)
    for word, value in zip([w for ws in found for w in ws], hashes.tolist()):
        by_word[word].add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len(set().union(*by_word.values())) == len(by_word)


def test_window_hashes():
    rng = np.random.default_rng(0)
    values = words.mix64(rng.integers(0, 4, 500).astype(np.uint64))
    windows = words.hash_windows(values, 3)
    seen = {}
    for i, h in enumerate(windows.tolist()):
        assert seen.setdefault(tuple(values[i : i + 3].tolist()), h) == h
    assert len(set(seen.values())) == len(seen)


# exact


def test_exact_groups_and_collisions(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["Same Text", "same text", "other", "ÀB", "àb", "", None]), "en", "s") for i in range(400)]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(documents(spark, rows), bucket_bytes=200).collect()}
    lower = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    groups = defaultdict(list)
    for i, t, _, _ in rows:
        groups[lower(t)].append(i)
    for i, t, _, _ in rows:
        group = groups[lower(t)]
        want = (max(group), len(group), i == max(group), hashlib.sha256(lower(t).encode()).hexdigest())
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == want


def test_equal_keys_with_different_bytes_stay_apart():
    schema = [("key", pa.int64()), ("entry", pa.int64()), ("n", pa.int64()), ("top", pa.int64()), ("body", pa.binary())]
    rows = [(7, 0, 1, 5, b"a"), (7, 1, 2, 9, b"b"), (7, 2, 3, 6, b"a"), (8, 3, 1, None, b"a")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), schema)], names=[n for n, _ in schema])
    out = sorted(tuple(r.values()) for b in exact_dedup._owners(iter([batch])) for r in b.to_pylist())
    assert out == [(0, 6, 2, 4), (1, 9, 1, 2), (2, 6, 2, 4), (3, None, 3, 1)]


def test_directory_splits_only_what_is_overfull():
    histogram = {p: 10 for p in range(16)} | {3: 1000}
    directory = exact_dedup.build_directory(histogram, capacity=100, width=4)
    load = Counter()
    for p, n in histogram.items():
        load[directory.pointers[p >> (4 - directory.depth)]] += n
    assert len(directory.pointers) == 1 << directory.depth == 16
    assert sum(load.values()) == sum(histogram.values())
    assert [n for b, n in load.items() if n > 100] == [1000]  # one prefix cannot be split further
    assert len(load) < 16


# near


def shingles(text, width):
    ws = [w for w in WORD.findall((text or "").lower())]
    return {tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()


def components_of(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_components(spark, width, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ELEMENTS", 2_000)  # several blocks per crowded bucket
    rng = random.Random(width)
    rows = []
    for _ in range(6):  # families whose members are linked with some of the family only
        base = prose(rng, 150, 5000)
        rows += [edited(rng, base, rng.randrange(0, 9)) for _ in range(40)]
    rows += [prose(rng, rng.randrange(1, 40), 30) for _ in range(60)] + ["a b", "A b", "", None, "a"]
    rows = [(i, t, "en", "s") for i, t in enumerate(rows)]
    sets = {i: shingles(t, width) for i, t, _, _ in rows}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components_of(sets, linked)
    got = {r.doc_id: r for r in near_dedup.near_groups(documents(spark, rows), width=width, percent=percent).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (want[i] == i) for i, r in got.items())
    assert len(set(want.values())) < len(rows) - 80


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(30):
        values = words.mix64(rng.integers(0, 2**62, 300).astype(np.uint64))
        a, b = values[:200], values[50:250]
        signed = near_dedup.superminhash(np.concatenate((a, b)), np.array([200, 200]), 140)
        assert np.isfinite(signed).all()
        errors.append((signed[0] == signed[1]).mean() - 150 / 250)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.05


def test_each_slot_of_a_small_set_is_filled():
    signed = near_dedup.superminhash(np.array([5, 6, 7], np.uint64), np.array([1, 2]), 140)
    assert signed.shape == (2, 140) and np.isfinite(signed).all()
    assert (np.sort(np.floor(signed[0])) == np.arange(140)).all()  # one element visits every slot once


# passages


def repeated(texts, width):
    ws = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + width]) for w in ws for i in range(len(w) - width + 1))
    out = []
    for w in ws:
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("width", [1, 5, 35])
def test_repeated_passages(spark, width, monkeypatch):
    monkeypatch.setattr(substring_dedup, "OWNER_BYTES", 20_000)
    rng = random.Random(width)
    passages = [prose(rng, rng.randrange(width - 1, 2 * width + 3), 10_000) for _ in range(12)]
    texts = [" ".join(rng.choice(passages) if rng.random() < 0.4 else prose(rng, rng.randrange(1, 60), 10_000) for _ in range(6)) for _ in range(150)]
    texts += [None, "", "the " * 80, texts[0]]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.drop_repeats(documents(spark, rows), width=width).collect()}
    assert [got[i] for i in range(len(texts))] == repeated(texts, width)


def test_covers_hold_every_difference():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# personal data


def plain_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    for _ in range(30_000):
        text = "".join(rng.choice("aZ0129.@_+- ()%é1234") for _ in range(rng.randrange(50)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("4111 1111 1111 1111, +1 (377) 555-0271, a@b.c_d@e.f")[0] == ("email", 40, 45)
    assert pii.base_spans("1" * 200_000 + "@" * 1000 + "a." * 50_000) == []


def test_disclosing_terms(spark):
    rng = random.Random(6)
    rows = [(i, f"{prose(rng, 20)} Quendolin writes to jo@x.org about {prose(rng, 20)}", "en", "s") for i in range(8)]
    rows += [(i, f"{prose(rng, 20)} writes to k{i}@x.org about {prose(rng, 20)}", "en", "s") for i in range(8, 60)]
    rows += [(60, None, "en", "s"), (61, "no data", "en", "s")]
    found = {r.doc_id: r for r in pii.find_personal_data(documents(spark, rows)).collect()}
    for i, text, _, _ in rows[:8]:
        assert [(s["kind"], s["start"], s["end"]) for s in found[i].spans] == plain_spans(text)
        assert [text[t["start"] : t["end"]] for t in found[i].terms] == ["Quendolin"]
        assert found[i].terms[0]["action"] == "remove" and found[i].terms[0]["disclosure"] == pytest.approx(1.0)
    assert all(not found[i].terms for i in range(8, 62))
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, rows)).collect()}
    assert "[email]" in clean[0] and "Quendolin" not in clean[0] and clean[61] == "no data"


def test_terms_of_entities_in_one_and_two_texts(spark):
    """Rare pairs are judged, with less weight, and copies of a text are no further evidence."""
    rng = random.Random(16)
    rows = [(i, f"{prose(rng, 20)} writes to k{i}@x.org about {prose(rng, 20)}", "en", "s") for i in range(80)]
    for i, name, mail in ((0, "Quendolin", "jo"), (1, "Ottokar", "al"), (2, "Ottokar", "al")):
        rows[i] = (i, f"{prose(rng, 20)} {name} writes to {mail}@x.org about {prose(rng, 20)}", "en", "s")
    rows += [(100 + i, rows[0][1], "en", "s") for i in range(40)]
    found = {r.doc_id: r for r in pii.find_personal_data(documents(spark, rows)).collect()}
    for i, text, _, _ in rows:
        name = "Quendolin" if i == 0 or i >= 100 else "Ottokar" if i in (1, 2) else None
        assert [text[t["start"] : t["end"]] for t in found[i].terms] == ([name] if name else [])
        assert all(t["action"] == "generalise" and t["disclosure"] == pytest.approx(1.0) for t in found[i].terms)


def test_terms_keep_off_every_span_of_a_text(spark):
    rng = random.Random(26)
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    rows = [(0, " ".join(f"éq{name(i)}@{name(i)}mail.org" for i in range(1200)), "en", "s")]
    rows += [(i, prose(rng, 20), "en", "s") for i in range(1, 80)]
    found = {r.doc_id: r for r in pii.find_personal_data(documents(spark, rows)).collect()}
    assert len(found[0].spans) == 1200 and not found[0].terms
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, rows)).collect()}
    assert clean[0] == " ".join(["é[email]"] * 1200)


def test_disclosing_terms_far_from_their_entity(spark):
    """A term that stands far from the entity, and is marked in texts that do not show the entity too."""
    rng = random.Random(36)
    rows = [(i, f"Éva-Quendolin {prose(rng, 300)} writes to jo@x.org about {prose(rng, 20)}", "en", "s") for i in range(12)]
    rows += [(12, f"{prose(rng, 9)} quendolin, {prose(rng, 9)} QUENDOLIN", "en", "s")]
    rows += [(i, f"{prose(rng, 20)} writes to k{i}@x.org about {prose(rng, 20)}", "en", "s") for i in range(13, 150)]
    found = {r.doc_id: r for r in pii.find_personal_data(documents(spark, rows)).collect()}
    names = {i: [text[t["start"] : t["end"]] for t in found[i].terms] for i, text, _, _ in rows}
    assert names == {i: ["Éva", "Quendolin"] if i < 12 else ["quendolin", "QUENDOLIN"] if i == 12 else [] for i in range(150)}
    assert found[12].terms[0]["disclosure"] == pytest.approx(1 + np.log2(12 / 13) / np.log2(150 / 12))
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, rows)).collect()}
    assert not any("quendolin" in clean[i].lower() for i in range(150))


# tokens


@pytest.fixture(scope="module")
def tokenizer():
    path = queries.default_vocabulary()
    with open(path, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read()), Tokenizer.from_file(path)


def test_tokens_equal_the_library(tokenizer):
    own, library = tokenizer
    rng = random.Random(1)
    letters = list("abcdefgh THE  \n\n\t'sdllre0123456789.,!?$%&|<>é ü ß\x85\x1c\x1f½²Ⅷ中文日本\U0001f600‍́�\x00  　")
    letters += ["<|endoftext|>", "<|endoftext", "'s", "'ll", " the", "  ", "\r\n"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", "a" * 3000, "!?" * 2000, "thntha" * 900, "12 " * 900, " " * 500]
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, np.int32).tolist() == want, text
        assert own.decode(pa.array([want], pa.list_(pa.int32())))[0].as_py() == library.decode(want, skip_special_tokens=False)


def test_bytes_that_are_not_text_decode_to_replacements(tokenizer):
    own, library = tokenizer
    lists = [[int(own.single[0xC3])], [], [int(own.single[0xE4]), int(own.single[0x41])], [50256]]
    got = own.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_long_texts_are_cut_at_pieces(tokenizer, monkeypatch):
    own, library = tokenizer
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    text = "It's  a\n\n test, 'tis   x " * 40 + "y" * 300
    assert np.frombuffer(own.encode([text])[0], np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


# mixing


def plain_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        rate = left / rest if rest else 0
        over = {s for s in order if s not in full and rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rate * weight[s] for s in order}
        full |= over


def test_mix_meets_its_targets(spark):
    rng = random.Random(9)
    counts = {"a": 300, "b": 30, "c": 200, "\U0001f600": 40, "ﬀ": 5, None: 60}
    rows = [(s, prose(rng, int(rng.paretovariate(1.2) * 20))) for s, n in counts.items() for _ in range(n)]
    rows = [(i, t, "en", s) for i, (s, t) in enumerate(rows)] + [(9000, None, "en", "a"), (9001, "", "en", "b")]
    got = mixing.mix_sources(documents(spark, rows)).collect()
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = plain_targets(sizes, (5, 2, 1), 3)
    taken, longest = Counter(), Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 20
    again = mixing.mix_sources(documents(spark, rows[::-1])).collect()
    assert {r.doc_id: r.copies for r in got} == {r.doc_id: r.copies for r in again}
    taken_rows = mixing.take_mix(documents(spark, rows)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in taken_rows} == {r.doc_id: r.copies for r in got if r.copies}


def test_inclusion_follows_the_probabilities(spark):
    """Over many seeds short texts are taken a little more often than long ones, and all with a chance."""
    rows = [(i, prose(random.Random(i), 16 if i % 2 else 256), "en", "ab"[i % 4 > 1]) for i in range(120)]
    docs = documents(spark, rows, clashing=False).cache()
    total = Counter()
    for seed in range(6):
        for r in mixing.mix_sources(docs, weights=(2, 1), seed=seed).collect():
            total[r.doc_id % 4] += r.copies
    assert total[1] >= total[0] and total[3] >= total[2] and min(total.values()) > 0


# archives


def test_archives_round_trip(spark):
    pages = [(i, f"http://x/{i % 7}\r\nX: y%0D", "ab" * (i % 5) * 40) for i in range(60)] + [(60, None, None), (None, "u", "ab" * 160)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(df), with_payload=True).collect()
    first = {}
    for i, _, t in pages:
        if i is not None:
            first.setdefault(t, i)
    assert len(rows) == len(pages) and all(r.verified for r in rows)
    for r in rows:
        _, url, text = next(p for p in pages if p[0] == r.page_id)
        text = text or ""
        old = first.get(text) if len(text) >= 100 and first.get(text) != r.page_id else None
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(text), hashlib.sha256(text.encode()).hexdigest())
        assert (r.record_type, r.refers_to) == ("response" if old is None else "revisit", old)
        assert bytes(r.payload) == (text.encode() if old is None else b"")


def test_reader_names_what_is_damaged():
    payload = b"p" * 300
    member = warc.write_record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None, "d")
    wrong = warc.write_record(2, "u", payload, "0" * 64, None, "d")
    plain = zlib.decompress(member, 31)
    short = zlib.compressobj(6, zlib.DEFLATED, 31)
    short = short.compress(plain.replace(b"Content-Length: 3", b"Content-Length: 9", 1)) + short.flush()
    changed = zlib.compressobj(6, zlib.DEFLATED, 31)
    changed = changed.compress(plain.replace(b"ppp", b"ppq", 1)) + changed.flush()
    read = lambda data, step=7: [r["problem"] for r in warc.read_records(data[i : i + step] for i in range(0, len(data), step))]
    assert read(member * 3) == [None] * 3
    assert read(member + wrong + member) == [None, "payload digest differs", None]
    assert read(changed + member) == ["block digest differs", None]
    assert "shorter" in read(member + short)[1] and "shorter" in read(member[:-30])[0] or "end" in read(member[:-30])[0]


def test_files_are_read_like_rows(spark, folder):
    members = b"".join(warc.write_record(i, None, b"x" * i, hashlib.sha256(b"x" * i).hexdigest(), None, "d") for i in range(20))
    with open(f"{folder}/a.warc.gz", "wb") as file:
        file.write(members)
    rows = warc.read_files(spark, folder).collect()
    assert sorted((r.page_id, r.payload_bytes, r.verified) for r in rows) == [(i, i, True) for i in range(20)]


# quality


def test_divergent_texts_are_rejected(spark):
    rng = random.Random(3)
    common = quality.COMMON_WORDS["en"]

    def clean(n):
        return " ".join(rng.choice(common) if rng.random() < 0.25 else "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(3, 9))) for _ in range(n))

    rows = [(i, clean(rng.randrange(60, 600)), "en", "s") for i in range(120)]
    odd = [clean(200).upper(), " ".join(w + "###" for w in clean(200).split()), " | ".join(clean(300).split()), clean(30), "all the same words " * 60]
    rows += [(1000 + i, t, "en", "s") for i, t in enumerate(odd)]
    got = {r.doc_id: r for r in quality.judge_quality(documents(spark, rows)).collect()}
    assert all(got[i].kept for i in range(120))
    assert not any(got[1000 + i].kept for i in range(len(odd)))
    assert [got[1000 + i].base_failed for i in range(len(odd))] == [False, False, False, True, True]
    kept = quality.keep_quality(documents(spark, rows)).select("doc_id").collect()
    assert {r[0] for r in kept} == set(range(120))


# models


def test_languages_on_held_out_rows(spark):
    rng = random.Random(8)
    styles = {"aa": ["the ing tion", "of and ther"], "bb": ["der schen keit", "und ung lich"], "cc": ["que ment aux", "les eau oir"]}
    rows = []
    for i in range(900):
        lang = rng.choice(list(styles))
        parts = rng.choice(styles[lang]).split()
        rows.append((i, " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(30)), lang, "s"))
    docs = documents(spark, rows, clashing=False)
    model = language.fit_languages(docs, F.col("doc_id") % 5 != 0, clusters=2)
    assert sorted(Counter(model.langs).items()) == [("aa", 2), ("bb", 2), ("cc", 2)]
    got = language.predict_languages(docs.where("doc_id % 5 = 0"), model).collect()
    truth = {i: lang for i, _, lang, _ in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.accepted for r in got]) > 0.9
    strange = language.predict_languages(documents(spark, [(1, "zzzz xxxx qqqq", None, None)], clashing=False), model).first()
    assert strange.lang_pred in styles and not strange.accepted


def test_grams_of_a_long_text_equal_those_of_its_parts(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 3000)
    data, offsets = words.text_bytes(pa.array([text, "ab c"], pa.string()))
    whole = language.gram_counts(data, offsets)
    monkeypatch.setattr(language, "SEGMENT", 1000)
    assert (language.gram_counts(data, offsets) == whole).all()


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.15
        ws = prose(rng, rng.randrange(20, 120), 800).replace("w", "word").split()
        ws = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in ws]
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vileness", "scumbag", "grottyling", "grottyform"]))
        rows.append((i, " ".join(ws), "en", "s"))
        labels.append((i, int(toxic) if rng.random() > 0.02 else 1 - int(toxic)))
    docs = documents(spark, rows, clashing=False)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, table.where("doc_id % 3 <> 1"))
    assert {"vileness", "scumbag"} <= set(model.lexicon) and "grott*" in model.lexicon
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    truth = {i: any(w in t for w in ("vileness", "scumbag", "grotty")) for i, t, _, _ in rows}
    held = [i for i in got if i % 3 == 1]
    assert np.mean([(got[i] >= 0.7) == truth[i] for i in held]) > 0.98
    assert (np.diag(model.voters["correlation"]) == 1).all() and model.voters["gold"][0] > 0.8 > 0.2 > model.voters["gold"][1]


def test_without_labels_everything_scores_zero(spark):
    docs = documents(spark, [(1, "some text", "en", "s")])
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).first().score == 0.0


def test_toxic_terms_of_a_small_language(spark):
    """Terms in less than a hundredth of the toxic texts, and more labels than the classifier is fitted on."""
    rng = random.Random(46)
    docs, labels = [], []
    for i in range(6000):
        toxic = i % 4 == 0
        word = ("rarevil" if i % 480 == 0 else "commonfoe") if toxic else "calm"
        docs.append((i, f"{prose(rng, 30)} {word}", "en", "s"))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(documents(spark, docs), table, fit_rows=500)
    assert {"rarevil", "commonfoe"} <= set(model.lexicon)


def test_long_heads_and_bad_members_lose_no_other_record():
    digest = hashlib.sha256(b"x").hexdigest()
    good = [warc.write_record(i, "u" * n, b"x", digest, None, "d") for i, n in ((1, 3), (2, 3 << 20), (3, 5))]
    packed = lambda data: (lambda z: z.compress(data) + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    plain = zlib.decompress(good[0], 31)
    bad = [packed(b"no head at all" * 100_000), packed(re.sub(rb"(\nContent-Length: )\d+(\r\n\r\nHTTP)", rb"\1many\2", plain)), packed(re.sub(rb"(\nContent-Length: )\d+(\r\n\r\nHTTP)", rb"\g<1>99999\2", plain))]
    data = b"".join([good[0], bad[0], good[1], bad[1], bad[2], good[2]])
    for step in (1000, 1 << 16):
        records = list(warc.read_records(data[i : i + step] for i in range(0, len(data), step)))
        assert [r["problem"] is None for r in records] == [True, False, True, False, False, True]
        assert [len(r["fields"]["warc-target-uri"]) for r in records if r["problem"] is None] == [3, 3 << 20, 5]
