"""One query per operator with production parameters, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.bpe import encode_texts, share_vocabulary
from pulsegrid.llm.exact_dedup import exact_groups
from pulsegrid.llm.language import fit_languages, predict_languages
from pulsegrid.llm.manifest import COLUMNS, build_manifest, fold, leaf_digest
from pulsegrid.llm.mixing import mix_sources
from pulsegrid.llm.near_dedup import near_groups
from pulsegrid.llm.packing import pack_documents
from pulsegrid.llm.pii import KINDS, TERM, find_personal_data
from pulsegrid.llm.quality import judge_quality, quality_sql
from pulsegrid.llm.resampling import resample
from pulsegrid.llm.substring_dedup import drop_repeats
from pulsegrid.llm.toxicity import fit_toxicity, score_toxicity
from pulsegrid.llm.warc import read_archives, write_archives
from pulsegrid.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(low) AS text_sha256
FROM (SELECT doc_id, {LOWERED} AS low FROM documents) t
WINDOW g AS (PARTITION BY low)""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


@_query(quality_sql())
def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


@_query()
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def default_vocabulary() -> str:
    """Place of the byte-level vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query()
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = share_vocabulary(spark, default_vocabulary())
    tokens = encode_texts(_table(spark, sf_dir, "documents"), shared, decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN o ON p.d = o.d""")
def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(_table(spark, sf_dir, "pages"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query(f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM c JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id
  WHERE 100 * both_n >= 85 * (p.n_shingles + q.n_shingles - both_n)),
r AS (SELECT doc_id, doc_id AS reach FROM n UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reach = l.x)
SELECT n.doc_id, n_shingles, component_id, n.doc_id = component_id AS kept
FROM n JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1) m ON n.doc_id = m.doc_id""")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(_table(spark, sf_dir, "documents"), width=3, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@_query("""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM p),
g AS (SELECT rid, list_distinct(flatten(list(range(i, i + 35)))) AS gone FROM h WHERE n > 1 GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda x, k: NOT list_contains(gone, k)), ' ') END) AS kept_sha256
FROM d LEFT JOIN g ON d.rid = g.rid""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    name = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform("spans", lambda s: name(s["kind"], s))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    every = F.concat(base, F.transform("terms", lambda s: name(F.lit(TERM), s)))
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"))


def _remainder(of: int) -> Column:
    """crc32 of the id as text modulo ``of``, which deals rows to learning and held-out sets."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


@_query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    model = fit_toxicity(docs, labels.where(~held_out).select("doc_id", "toxic"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = fit_languages(docs, ~held_out)
    return predict_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


#: The change of a CRC-32 by each byte, as a list ``tab`` in SQL.
CRC_STEPS = """step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab)"""


def crc_sql(h: str) -> str:
    """CRC-32 of the bytes whose upper-case hex text is ``h``, beside the list ``tab``."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len({h}), 2),
         lambda i: 16 * strpos('123456789ABCDEF', {h}[i + 1]) + strpos('123456789ABCDEF', {h}[i + 2]))),
         lambda c, v: xor(tab[(xor(c, v) & 255) + 1], c >> 8)))"""


@_query(f"""
WITH {CRC_STEPS},
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
f AS (SELECT rid, unnest(w) AS w FROM d),
x AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT unnest(w) FROM g) u),
b AS (
  SELECT w, {crc_sql('h')} % 10000 AS bucket FROM x, step),
s AS (SELECT bucket, count(*) AS n FROM f JOIN b USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(w) AS w FROM g) u JOIN b USING (w) GROUP BY 1),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
         / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
v AS (SELECT rid, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (w) JOIN gain USING (bucket) GROUP BY 1),
r AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN v USING (rid)),
z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS k,
             count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM o""")
def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _sql_leaf(n_chars: str) -> str:
    parts = [f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


def _sql_parents(h: str) -> str:
    return f"list_transform(range(1, len({h}) + 1, 2), lambda i: sha256({h}[i] || coalesce({h}[i + 1], '')))"


def _sql_path(levels: str, place: str) -> str:
    """Side and sibling of a place at every level below the root, as strings ``l``, ``r`` or ``-`` and the digest."""
    at = f"({place} // (2 ** (k - 1))::BIGINT)"
    return f"""list_transform(range(1, len({levels})), lambda k: CASE WHEN {at} % 2 = 1 THEN 'l' || {levels}[k][{at}]
           WHEN {at} + 2 > len({levels}[k]) THEN '-' ELSE 'r' || {levels}[k][{at} + 2] END)"""


@_query(f"""
WITH RECURSIVE {CRC_STEPS},
leaves AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("(n_chars::HUGEINT + 1)")} AS bad,
         coalesce({crc_sql("hex(encode(doc_id::VARCHAR))")} % 7 = 0, false) AS hit FROM documents, step),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM leaves),
up AS (
  SELECT lang, [list(leaf ORDER BY pos)] AS lv FROM placed GROUP BY lang
  UNION ALL SELECT lang, list_append(lv, {_sql_parents("lv[-1]")}) FROM up WHERE len(lv[-1]) > 1),
sub AS (SELECT lang, lv, lv[-1][1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE len(lv[-1]) = 1),
top AS (
  SELECT [list(subroot ORDER BY pos)] AS lv FROM sub
  UNION ALL SELECT list_append(lv, {_sql_parents("lv[-1]")}) FROM top WHERE len(lv[-1]) > 1),
paths AS (
  SELECT doc_id, leaf, bad, hit, subroot, top.lv[-1][1] AS root,
         {_sql_path("sub.lv", "p.pos")} || {_sql_path("top.lv", "sub.pos")} AS path
  FROM placed p JOIN sub ON p.lang IS NOT DISTINCT FROM sub.lang, top WHERE len(top.lv[-1]) = 1),
folded AS (
  SELECT *, list_reduce(list_prepend(CASE WHEN hit THEN bad ELSE leaf END, path), lambda a, x:
         sha256(CASE x[1] WHEN 'l' THEN x[2:] || a WHEN 'r' THEN a || x[2:] ELSE a END)) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(path, lambda x: x[2:]), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in COLUMNS}
    values["n_chars"] = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = F.when(_remainder(7) == 0, leaf_digest(list(values.values())))
    rows = build_manifest(docs, seen=changed)
    rows = rows.withColumn("folded_root", fold(F.coalesce("seen", "leaf"), F.col("proof"), F.col("sides")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def word_vocabulary() -> str:
    """Place of the lower-case vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query()
def op13_square_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), share_vocabulary(spark, word_vocabulary()))
