"""Personal data: pattern spans, and terms that give the protected entities away.

Patterns find the protected entities. A term of a text with an entity discloses it as far as seeing the term
tells which entity is meant: with document counts ``n`` over the whole corpus of ``N`` different texts,

    PMI(t; e) = log2(n(e, t) * N / (n(e) * n(t))),   IC(e) = log2(N / n(e)),   disclosure = PMI / IC

which is 1 for a term that occurs with this entity only. Few texts are weak evidence, so a term is judged
by the disclosure with n(e, t) / n(t) replaced by the median of its confidence distribution, close to
(n(e, t) - 1/3) / (n(t) + 1/3): one text of one counts as a half, eight of eight as 0.92. Every pair is
judged. Terms at ``remove`` or above are taken out, those at ``generalise`` or above are replaced by a class.

IC grows with the corpus, and with it the disclosure of any rare term, so the share n(e, t) / n(t) itself, as
bounded above, has floors that do not depend on N: ``WITHIN`` for marking the term in texts of the entity, and the
stricter ``BEYOND`` for marking it in texts that do not show the entity.

One pass over the texts counts every term of the corpus per batch and lists the terms of the texts with
entities; what follows works on numbers only. A second pass marks the disclosing terms wherever they
stand, in texts without the entity too: a bitmap of fixed size sorts out most other terms in the tasks, a
join with the disclosing terms decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import keyed_texts, map_batches, stored
from pulsegrid.llm.words import LOWER, find_words, hash_words, text_bytes, text_slices

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The patterns of the base kinds, cut so that each runs in linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: Code points of the shortest term that is judged; single letters are not.
MIN_TERM = 2
#: Least bounded share of a term's texts that are the entity's, in texts of the entity and elsewhere: one text of one
#: reaches the first, six of seven the second.
WITHIN, BEYOND = 0.499, 0.75
#: Bits of the bitmap for each disclosing term, and the largest size as a power of two (16 MB).
BITMAP_BITS, BITMAP_POWER = 32, 27

_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20

SCAN = "th long, entities array<string>, terms array<long>, term long, n double"
MARKED = "doc_id long, th long, spans array<struct<kind:string,start:int,end:int>>, hits array<struct<term:long,start:int,end:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_HIT = pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_SCAN = pa.schema([("th", pa.int64()), ("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.int64())), ("term", pa.int64()), ("n", pa.float64())])
_MARKED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("spans", pa.list_(_SPAN)), ("hits", pa.list_(_HIT))])


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def find_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before an @ that no earlier match has used, and a domain."""
    used, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > used and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            used = domain.end()
            yield start, used
        at = text.find("@", max(at + 1, used))


def find_ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each run of numbers joined by dots."""
    for run in DOTTED.finditer(text):
        numbers, start = run.group().split("."), run.start()
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or 0) <= 255 for n in four):
                yield start, end
            start = end + 1


def find_cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def find_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


_FINDERS = {"email": ("@", find_emails), "ip": (".", find_ips), "card": ("", find_cards), "phone": ("+", find_phones)}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind, then start; ends are exclusive."""
    return [(kind, a, b) for kind in KINDS if _FINDERS[kind][0] in text for a, b in _FINDERS[kind][1](text)]


def entity_of(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', value)}"


def find_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every term (letters, that is ASCII letters and all beyond ASCII; A-Z lower-cased), where it starts
    and ends in code points, and the first term of each text."""
    data, offsets = text_bytes(column)
    folded = _FOLD[data]
    starts, ends, first = find_words(folded, offsets)
    chars = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    base = np.repeat(chars[offsets[:-1]], np.diff(first))
    return hash_words(folded, starts, ends), chars[starts] - base, chars[ends] - base, first


def apart(spans: list[tuple[str, int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which terms overlap none of the spans: no span begins before the term's end and ends behind its start."""
    begun = np.searchsorted(np.sort([a for _, a, _ in spans]), ends, "left")
    return begun <= np.searchsorted(np.sort([b for _, _, b in spans]), starts, "right")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text with entities, and a row per distinct term of each slice with the number of its texts; equal
    texts count as one. A row without both counts the texts."""
    for part in text_slices(batches, "text"):
        column = part.column("text")
        hashes, starts, ends, first = find_terms(column)
        owner = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(first))
        order = np.lexsort((owner, hashes))
        h, o = hashes[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        weights = 1 / part.column("copies").to_numpy(zero_copy_only=False)
        terms, at = np.unique(h[new], return_index=True)
        counts = np.add.reduceat(weights[o[new]], at) if len(at) else np.zeros(0)
        blank = pa.nulls(len(terms))
        yield pa.RecordBatch.from_arrays(
            [blank.cast(f.type) for f in list(_SCAN)[:3]] + [pa.array(terms.view(np.int64)), pa.array(counts, pa.float64())], schema=_SCAN
        )
        rows = [{"n": weights.sum()}]
        for i, (th, text) in enumerate(zip(part.column("th").to_pylist(), column.to_pylist())):
            spans = base_spans(text)
            if spans:
                own = slice(first[i], first[i + 1])
                fit = (ends[own] - starts[own] >= MIN_TERM) & apart(spans, starts[own], ends[own])
                rows.append({"th": th, "entities": sorted({entity_of(k, text[a:b]) for k, a, b in spans}), "terms": np.unique(hashes[own][fit]).view(np.int64)})
        yield pa.RecordBatch.from_pylist(rows, _SCAN)


def _marker(shared, power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text: its spans, and the terms outside of them that the bitmap has."""
        for part in text_slices(batches, "text"):
            column, words = part.column("text"), shared.value
            hashes, starts, ends, first = find_terms(column)
            place = hashes >> np.uint64(64 - power)
            fit = (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1) & (ends - starts >= MIN_TERM)
            kept = np.flatnonzero(fit)
            cuts = np.searchsorted(kept, first)
            rows = []
            for i, (doc_id, th, text) in enumerate(zip(*[part.column(c).to_pylist() for c in ("doc_id", "th")], column.to_pylist())):
                spans, own = base_spans(text), kept[cuts[i] : cuts[i + 1]]
                if spans:
                    own = own[apart(spans, starts[own], ends[own])]
                hits = zip(hashes[own].view(np.int64).tolist(), starts[own].tolist(), ends[own].tolist())
                rows.append({"doc_id": doc_id, "th": th, "spans": [{"kind": k, "start": a, "end": b} for k, a, b in spans], "hits": [{"term": h, "start": a, "end": b} for h, a, b in hits]})
            yield pa.RecordBatch.from_pylist(rows, _MARKED)

    return run


def term_bitmap(terms: DataFrame) -> tuple[np.ndarray, int]:
    """Words of 64 bits with a bit set for each term by the first bits of its hash, and the number of these bits."""
    power = min(BITMAP_POWER, max(10, (BITMAP_BITS * terms.count()).bit_length()))
    place = F.shiftrightunsigned("term", 64 - power)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    rows = terms.select(place.alias("place")).groupBy(F.expr("place div 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    words = np.zeros(1 << power - 6, np.uint64)
    table = rows.toArrow()  # at most 2**21 rows of two numbers
    words[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return words, power


def with_copies(texts: DataFrame) -> DataFrame:
    """Texts with ``copies``, the rows that have an equal text."""
    groups = texts.groupBy("th").agg(F.count("*").alias("copies"))
    # stored, so that the planner knows how small it is before the texts are shuffled for the join
    groups = stored(groups.where("copies > 1"), "copies")
    return texts.join(groups, "th", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))


def disclosing_terms(scan: DataFrame, generalise: float, remove: float) -> tuple[DataFrame, DataFrame]:
    """``term, disclosure, bounded, action, beyond`` of the terms whose bounded disclosure of some entity is at or above
    the thresholds, and the pairs ``th, term`` of the texts that show such an entity.

    Entities of the same texts have the same counts with every term, so they are judged as one: a text with
    many entities of its own has no more pairs than terms. Terms too frequent for the entity, were they in all
    of its texts, are left out before pairs are counted.
    """
    total = round(scan.where("term is null and entities is null").agg(F.sum("n")).first()[0] or 0)
    mentions = scan.select("th", F.explode("entities").alias("entity")).distinct()
    sets = mentions.groupBy("entity").agg(F.count("*").alias("n_e"), F.bit_xor(F.xxhash64("th")).alias("texts"))
    sets = mentions.join(sets, "entity").select("th", "n_e", "texts").distinct()
    counts = scan.where("term is not null").groupBy("term").agg(F.round(F.sum("n")).alias("n_t"))  # whole numbers but for rounding
    information = F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
    given = lambda share: F.when(information > 0, (information + F.log2(share)) / information)
    bounded = lambda n: (n - 1 / 3) / (F.col("n_t") + 1 / 3)
    seen = scan.select("th", F.explode("terms").alias("term")).distinct().join(counts, "term")
    likely = (given(bounded(F.col("n_e"))) >= min(generalise, remove)) & (bounded(F.col("n_e")) >= WITHIN)
    held = stored(seen.join(sets, "th").where(likely).select("th", "texts", "n_e", "term", "n_t"), "pairs")
    pairs = held.groupBy("texts", "n_e", "term", "n_t").agg(F.count("*").alias("n_et"))
    share = bounded(F.col("n_et"))
    pairs = pairs.select("texts", "term", share.alias("share"), given(share).alias("bounded"), given(F.col("n_et") / F.col("n_t")).alias("disclosure"))
    action = F.when(F.col("bounded") >= remove, "remove").when(F.col("bounded") >= generalise, "generalise")
    pairs = stored(pairs.withColumn("action", action).where((F.col("share") >= WITHIN) & F.col("action").isNotNull()), "judged")
    most = F.max(F.struct("bounded", "disclosure", "action")).alias("d")
    terms = pairs.groupBy("term").agg(most, F.max(F.col("share") >= BEYOND).alias("beyond")).select("term", "d.*", "beyond")
    return terms, held.join(pairs.select("texts", "term").hint("merge"), ["texts", "term"]).select("th", "term").distinct()


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = 0.7, remove: float = 0.95
) -> DataFrame:
    """Per row: ``doc_id``, ``th``, ``spans`` of the base kinds and ``terms`` with start, end, disclosure and action.

    A term is a word of at least ``MIN_TERM`` code points. Offsets are code points, ends exclusive. ``disclosure`` is PMI / IC, ``action`` follows its bounded value.
    A null or empty text has no spans. Every row is marked, but equal texts count as one; null ids pass
    through; an entity that all texts hold is not disclosed (IC is 0). An empty table gives no rows; other
    columns are not read.
    """
    texts = keyed_texts(docs, id_col, text_col)
    scan = stored(map_batches(with_copies(texts), _scan, SCAN), "terms")
    terms, shown = (stored(df, "disclosing") for df in disclosing_terms(scan, generalise, remove))
    words, power = term_bitmap(terms)
    marked = map_batches(texts, _marker(docs.sparkSession.sparkContext.broadcast(words), power), MARKED)
    marked = stored(marked.withColumn("row", F.monotonically_increasing_id()), "spans")
    hits = marked.where(F.size("hits") > 0).select("row", "th", F.explode("hits").alias("h")).select("row", "th", "h.*")
    # the same plan at every size: terms and pairs grow with the corpus
    hits = hits.join(terms.hint("merge"), "term")
    hits = hits.join(shown.withColumn("own", F.lit(True)).hint("merge"), ["th", "term"], "left").where("beyond or own")
    found = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure", "action"))).alias("terms"))
    joined = marked.join(found, "row", "left")
    none = F.expr("cast(array() as array<struct<start:int,end:int,disclosure:double,action:string>>)")
    return joined.select("doc_id", "th", "spans", F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id`` and ``text`` with entities and disclosing terms replaced by their class, or taken out.

    A null text becomes empty; repeated rows and null ids stay rows of their own; an empty table gives no rows."""
    found = find_personal_data(docs, id_col, text_col, **options).dropDuplicates(["doc_id", "th"])
    texts = keyed_texts(docs, id_col, text_col)
    same = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["th"] == found["th"])
    joined = texts.join(found, same).select(texts["doc_id"], "text", "spans", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            out = []
            for text, spans, terms in zip(*[part.column(c).to_pylist() for c in ("text", "spans", "terms")]):
                cuts = [(s["start"], s["end"], f"[{s['kind']}]") for s in spans]
                cuts += [(t["start"], t["end"], "[term]" if t["action"] == "generalise" else "") for t in terms]
                made, at = [], 0
                for start, end, name in sorted(cuts):
                    if start >= at:
                        made += [text[at:start], name]
                    at = max(at, end)
                out.append("".join([*made, text[at:]]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return map_batches(joined, run, "doc_id long, text string")
