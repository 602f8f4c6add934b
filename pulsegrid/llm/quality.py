"""Quality by divergence from the language: built-in expressions only.

Two histograms of a text, its character classes and its use of common words, are compared with the
histograms of all texts of the same language by the Jensen-Shannon distance (base 2, 0 to 1). A
short text has a rough histogram, so the distance that is still accepted falls with the number of
words: ``floor + allowance / sqrt(words)``; texts below ``MIN_WORDS`` words are judged by the base
rule alone. The references come from one pass over all texts: a handful of sums per language.
Everything else is per row, so no text is ever shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import packed

SPACE = r"[\x20\x09-\x0D]+"
#: Frequent function words per language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it on was as be with by are this at from".split(),
    "fr": "de la le et les des en un une que est pour dans du par sur avec pas qui au".split(),
    "de": "der die und das den von zu mit ist des im für auf nicht ein eine als auch es dem".split(),
    "es": "de la que el en y los del las un por con una su para es al lo como más".split(),
}
#: Character classes of a text without its white space, taken out one after the other.
CLASSES = ["[a-z]+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\-]+", r"[^\x00-\x7F]+"]
MIN_WORDS = 50
MIN_REFERENCE_WORDS = 1000
CHAR_FLOOR, CHAR_ALLOWANCE = 0.2, 0.9
WORD_FLOOR, WORD_ALLOWANCE = 0.15, 1.4
OTHER = "other"
HIDDEN = ["words", "known", "chars", "marks", "language"]


def _language(lang: Column) -> Column:
    """The language if its common words are listed, else one pooled group."""
    return F.when(lang.isin(list(COMMON_WORDS)), lang).otherwise(F.lit(OTHER))


def _histograms(rows: DataFrame) -> DataFrame:
    """Adds words, character-class counts and common-word counts to rows with ``text`` and ``lang``."""
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), "")).withColumn("language", _language(F.col("lang")))
    rows = rows.withColumn("rest0", F.array_join("words", ""))
    for i, pattern in enumerate(CLASSES):
        rows = rows.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", pattern, ""))
    size = [F.length(f"rest{i}") for i in range(len(CLASSES) + 1)]
    taken = [a - b for a, b in zip(size, size[1:])] + [size[-1]]
    rows = rows.withColumn("chars", F.array(*[c.cast("long") for c in taken]))

    every = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    rows = rows.withColumn("known", F.filter("words", lambda w: w.isin(every)))
    counts = lambda ws: F.transform(F.array(*[F.lit(w) for w in ws]), lambda w: F.size("known") - F.size(F.array_remove("known", w)))
    per_language = reduce(lambda c, kv: c.when(F.col("language") == kv[0], counts(kv[1])), COMMON_WORDS.items(), F)
    rows = rows.withColumn("marks", F.coalesce(per_language, F.array().cast("array<int>")))
    used = F.aggregate("marks", F.lit(0), lambda a, x: a + x)
    rows = rows.withColumn("marks", F.concat("marks", F.array(F.size("words") - used)).cast("array<long>"))
    return rows.drop(*[f"rest{i}" for i in range(1, len(CLASSES) + 1)])


def _references(rows: DataFrame) -> DataFrame:
    """One row per language: summed histograms over every text long enough to be judged."""
    judged = _histograms(rows)
    longest = max(map(len, COMMON_WORDS.values())) + 1
    # a condition inside the sums: a filter would be moved down and split every text once more
    long_enough = F.size("words") >= MIN_WORDS
    cell = lambda c, i: F.when(long_enough, F.get(F.col(c), F.lit(i)))
    total = lambda c, n: F.array(*[F.coalesce(F.sum(cell(c, i)), F.lit(0)) for i in range(n)])
    return judged.groupBy("language").agg(
        total("chars", len(CLASSES) + 1).alias("ref_chars"), total("marks", longest).alias("ref_marks")
    )


def _distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; 0 if either is empty."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def term(a: Column, b: Column) -> Column:
        p, q = a / total(own), F.coalesce(b, F.lit(0)) / total(reference)
        return (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2

    divergence = F.aggregate(F.zip_with(own, reference, term), F.lit(0.0), lambda s, x: s + x)
    return F.when((total(own) > 0) & (total(reference) > 0), F.sqrt(F.greatest(divergence, F.lit(0.0)))).otherwise(F.lit(0.0))


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a 3-word window that occurs twice or more in its text.

    Only texts that have a repeated window at all sort their windows.
    """
    after = lambda i, k: F.get(F.col("words"), i + k)
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.lit(0), after(i, 1), F.lit(0), after(i, 2)),
    )
    rows = rows.withColumn("windows", windows)
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(some, placed))
    other = lambda i: F.get(F.col("placed"), i)["h"]
    twice = F.filter(
        "placed", lambda s, i: s["h"].eqNullSafe(other(i + 1)) | s["h"].eqNullSafe(F.when(i > 0, other(F.greatest(i - 1, F.lit(0)))))
    )
    spread = F.flatten(F.transform(twice, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2)))
    count = F.when(F.col("placed").isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(spread)))
    return rows.withColumn("n_repeat_words", count.cast("long")).drop("windows", "placed")


def quality_columns(rows: DataFrame) -> DataFrame:
    """Rows with ``text`` and ``lang`` plus the counts, the two distances, ``base_failed`` and ``kept``."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    references = F.broadcast(_references(rows.select("text", "lang")))  # at most one row per listed language and one more
    full = _histograms(rows).join(references, "language", "left")
    n = F.size("words").cast("long")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    full = full.withColumn("lines", lines)
    full = (
        full.withColumn("n_words", n)
        .withColumn("word_chars", F.length("rest0").cast("long"))
        .withColumn("n_symbols", F.regexp_count("rest0", F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .drop("rest0", "lines")
    )
    full = _repeats(full)
    full = full.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    known = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x) >= MIN_REFERENCE_WORDS
    distance = lambda own, ref: F.when(known(ref), _distance(F.col(own), F.col(ref))).otherwise(F.lit(0.0))
    full = full.withColumn("char_distance", F.when(F.col("base_failed"), 0.0).otherwise(F.coalesce(distance("chars", "ref_chars"), F.lit(0.0))))
    full = full.withColumn("word_distance", F.when(F.col("base_failed"), 0.0).otherwise(F.coalesce(distance("marks", "ref_marks"), F.lit(0.0))))
    root = F.sqrt(F.col("n_words").cast("double"))
    far = (F.col("char_distance") > CHAR_FLOOR + CHAR_ALLOWANCE / root) | (
        (F.col("language") != OTHER) & (F.col("word_distance") > WORD_FLOOR + WORD_ALLOWANCE / root)
    )
    return full.withColumn("kept", ~F.col("base_failed") & ~far).drop(*HIDDEN, "ref_chars", "ref_marks")


def _row_text(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return packed(docs, F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: its id, counts, distances, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rule. A null or unlisted language is compared
    with the pooled reference of such texts, by character classes only; a reference of fewer than
    ``MIN_REFERENCE_WORDS`` counts is not used. Repeated rows and ids are judged row by row; an empty
    table gives no rows; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    return quality_columns(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept"
    )


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The row number keeps the optimiser from moving the verdict below the columns that it is made of, where
    each of them would be written out again for every use.
    """
    judged = quality_columns(_row_text(docs, text_col, lang_col)).withColumn("place", F.monotonically_increasing_id())
    return judged.where("kept and place >= 0").select("row.*")


def quality_sql(table: str = "documents") -> str:
    """The same rows without the distances in DuckDB SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    space = r"'[\x20\x09-\x0D]+'"
    classes = ", ".join(
        f"length(rest{i}) - length(rest{i + 1}) AS c{i}" for i in range(len(CLASSES))
    ) + f", length(rest{len(CLASSES)}) AS c{len(CLASSES)}"
    longest = max(map(len, COMMON_WORDS.values()))
    lists = " ".join(f"WHEN {q(k)} THEN [{', '.join(map(q, ws))}]" for k, ws in COMMON_WORDS.items())
    rests, frm = "", "(SELECT doc_id, lang, coalesce(text, '') AS text, row_number() OVER () AS rid FROM " + table + ") d0"
    frm = f"(SELECT *, list_filter(regexp_split_to_array(text, {space}), lambda x: x <> '') AS words FROM {frm}) d1"
    frm = f"(SELECT *, array_to_string(words, '') AS rest0 FROM {frm}) d2"
    for i, p in enumerate(CLASSES):
        frm = f"(SELECT *, regexp_replace(rest{i}, {q(p.replace(chr(92) + chr(34), chr(34)))}, '', 'g') AS rest{i + 1} FROM {frm}) e{i}"
    marks = ", ".join(f"CASE WHEN len(ws) >= {i + 1} THEN len(list_filter(words, lambda x: x = ws[{i + 1}])) ELSE 0 END AS m{i}" for i in range(longest))
    used = " + ".join(f"m{i}" for i in range(longest))
    nc, nm = len(CLASSES) + 1, longest + 1
    refs = ", ".join([f"sum(c{i}) AS rc{i}" for i in range(nc)] + [f"sum(m{i}) AS rm{i}" for i in range(nm)])

    def divergence(own: str, ref: str, n: int) -> str:
        a, b = "(" + " + ".join(f"{own}{i}" for i in range(n)) + ")", "(" + " + ".join(f"{ref}{i}" for i in range(n)) + ")"
        part = lambda x, m: f"CASE WHEN {x} > 0 THEN ({x}) * log2(({x}) / ({m})) ELSE 0.0 END"
        terms = []
        for i in range(n):
            p, r = f"{own}{i}::DOUBLE / {a}", f"{ref}{i}::DOUBLE / {b}"
            m = f"({p} + {r}) / 2"
            terms.append(f"({part(p, m)} + {part(r, m)}) / 2")
        return f"CASE WHEN {b} >= {MIN_REFERENCE_WORDS} AND {a} > 0 THEN sqrt(greatest({' + '.join(terms)}, 0.0)) ELSE 0.0 END"

    return f"""
WITH base AS (
  SELECT rid, doc_id, text, words, rest0, coalesce(CASE WHEN lang IN ({', '.join(map(q, COMMON_WORDS))}) THEN lang END, {q(OTHER)}) AS language, {classes}
  FROM {frm}),
marked AS (
  SELECT *, len(words) - ({used}) AS m{longest}
  FROM (SELECT *, {marks} FROM (SELECT *, CASE language {lists} ELSE [] END AS ws FROM base) b1) b2),
refs AS (SELECT language, {refs} FROM marked WHERE len(words) >= {MIN_WORDS} GROUP BY language),
places AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w3
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM base) t),
doubled AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w3) AS n FROM places),
covered AS (
  SELECT rid, count(DISTINCT spot) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS spot FROM doubled WHERE n > 1) t GROUP BY rid),
counted AS (
  SELECT m.*, r.* EXCLUDE (language), len(words) AS n_words, length(rest0) AS word_chars,
         length(rest0) - length(regexp_replace(rest0, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM marked m LEFT JOIN refs r ON m.language = r.language LEFT JOIN covered c ON m.rid = c.rid),
judged AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         coalesce({divergence('c', 'rc', nc)}, 0.0) AS char_distance, coalesce({divergence('m', 'rm', nm)}, 0.0) AS word_distance
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (char_distance > {CHAR_FLOOR} + {CHAR_ALLOWANCE} / sqrt(n_words)
         OR (language <> {q(OTHER)} AND word_distance > {WORD_FLOOR} + {WORD_ALLOWANCE} / sqrt(n_words))) AS kept
FROM judged"""
