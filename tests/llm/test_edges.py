"""Every operator and stage on odd rows, on an empty table, and with clashing columns."""

import pytest
from tables import SCHEMA, documents, odd_rows

import corpus_pipeline
from pulsegrid.llm import bpe, exact_dedup, language, manifest, mixing, near_dedup, packing, pii, quality, queries, resampling, substring_dedup, toxicity, warc
from pyspark.sql import functions as F


def _language(docs):
    return language.predict_languages(docs, language.fit_languages(docs, F.lit(True)))


def _toxicity(docs):
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 9, F.col("doc_id") % 2).cast("int").alias("toxic"))
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))


def _bpe(docs):
    shared = bpe.share_vocabulary(docs.sparkSession, queries.default_vocabulary())
    return bpe.decode_ids(bpe.encode_texts(docs, shared), shared)


def _warc(docs):
    return warc.read_archives(warc.write_archives(docs, "doc_id", "source", "text")).withColumnRenamed("page_id", "doc_id")


def _pack(docs):
    packed = packing.pack_documents(docs, bpe.share_vocabulary(docs.sparkSession, queries.word_vocabulary()))
    return packed.where("piece = 0")


OPERATORS = {
    "toxicity": _toxicity,
    "warc": _warc,
    "quality": quality.judge_quality,
    "mixing": mixing.mix_sources,
    "language": _language,
    "near": near_dedup.near_groups,
    "bpe": _bpe,
    "substring": substring_dedup.drop_repeats,
    "pii": pii.find_personal_data,
    "exact": exact_dedup.exact_groups,
    "resampling": lambda docs: resampling.resample(docs, docs),
    "manifest": lambda docs: manifest.build_manifest(docs, columns=("doc_id", "text", "lang")),
    "packing": _pack,
}


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_rows()).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(spark, odd, name):
    got = OPERATORS[name](odd).select("doc_id").collect()
    assert sorted((r[0] or -1) for r in got) == sorted((r[0] or -1) for r in odd_rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = documents(spark, [])
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, odd, name, stage):
    out = stage(spark, odd, "")
    if name != "tokens":
        assert out.columns == odd.columns
        assert out.dtypes == odd.dtypes
        assert out.exceptAll(odd).count() == 0 or name == "mix"
    assert out.count() <= 3 * odd.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_empty_table(spark, name, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def test_defined_results(spark, odd):
    exact = exact_dedup.exact_groups(odd)
    assert exact.where("kept").count() == 8  # five equal texts and three empty ones leave one each
    assert {r.keep_id for r in exact.where("group_size = 5").collect()} == {10}
    near = {(r.doc_id, r.n_shingles): r for r in near_dedup.near_groups(odd).collect()}
    assert near[3, 0].component_id == 3 and near[3, 0].kept
    assert {r.component_id for (i, n), r in near.items() if i in (1, 2, 10) or (i is None and n)} == {1}
    judged = {r.doc_id: r for r in quality.judge_quality(odd).collect()}
    assert judged[3].n_words == 0 and judged[3].base_failed and not judged[3].kept
    assert judged[11].n_repeat_words == 90 and judged[11].base_failed
    spoken = {r.doc_id: r for r in _language(odd).collect()}
    assert spoken[3].lang_pred == "und" and spoken[5].lang_pred == "und" and spoken[1].lang_pred in ("en", "de", "xx")
    mixed = {r.doc_id: r for r in mixing.mix_sources(odd).collect()}
    assert mixed[3].taken == 0 and mixed[9].size == 500_000
    decoded = {(r.doc_id, r.decoded) for r in _bpe(odd).collect()}
    assert decoded == {(i, t or "") for i, t, _, _ in odd_rows()}
