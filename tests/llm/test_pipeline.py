"""Every stage against a plain version of it, on the given documents and on odd rows."""

import pytest

import corpus_pipeline as cp
from larkspur.llm import mixing, pii, quality_classifier
from larkspur.llm.queries import MIX_EXPONENTS, mix_dimensions
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import check_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_the_stages():
    assert [name for name, _ in cp.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "personal data", "mixing to target weights", "best-fit packing",
    ]


def test_rejected_documents_go(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = cp.keep_good(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    model = quality_classifier.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert ids == {r["doc_id"] for r in quality_classifier.quality_scores(docs, model).collect() if r["score"] >= 0.5}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in ids for i in good) >= 0.97 * len(good) and sum(i in ids for i in bad) <= 0.1 * len(bad)


def test_one_of_each_group_stays(spark, docs):
    kept = cp.keep_one_of_each_group(spark, docs, SF_DIR)
    assert kept.columns == COLUMNS
    want = brute([(d["doc_id"], d["text"]) for d in documents()], 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, found in want.items() if {c for _, c in found} == {i})


def test_personal_data_is_hidden(spark, docs):
    got = {r["doc_id"]: r for r in cp.hide_personal_data(spark, docs, SF_DIR).collect()}
    assert set(got) == {d["doc_id"] for d in documents()}
    for d in documents():
        text = pii.redact(d["text"], sum(pii.find(d["text"]), []))
        assert (got[d["doc_id"]]["text"], got[d["doc_id"]]["n_chars"]) == (text, len(text))
        assert pii.identifiers(text) == []


def test_the_sample_is_that_of_the_operator(spark, docs):
    mixed = cp.mix_sources(spark, docs, SF_DIR)
    assert mixed.columns == COLUMNS
    rows = {d["doc_id"]: d for d in documents()}
    lots = mixing.mix(docs, mix_dimensions(), MIX_EXPONENTS).collect()
    kept = {r["row"]["doc_id"] for r in lots if r["kept"]}
    assert all(r.asDict() == rows[r["doc_id"]] for r in mixed.collect())
    assert {r["doc_id"] for r in mixed.collect()} == kept
    # as many as the probabilities say, within four deviations
    expected, variance = sum(r["probability"] for r in lots), sum(r["probability"] * (1 - r["probability"]) for r in lots)
    assert abs(len(kept) - expected) <= 4 * variance**0.5 and 0 < len(kept) < len(rows)


def test_run_packs_what_the_stages_keep(spark, docs):
    rows = cp.run(spark, SF_DIR).collect()
    left = docs
    for _, stage in cp.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, SF_DIR).collect(), docs.schema)
    check_rows(rows, {r["doc_id"]: r["text"] for r in left.collect()})
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in left.collect()}


@pytest.mark.parametrize("frame", [odd_docs, no_docs])
def test_odd_rows_pass_every_stage(spark, frame):
    docs = frame(spark)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_DIR)
        rows = out.collect()
        assert name == "best-fit packing" or out.columns == docs.columns, name
        docs = spark.createDataFrame(rows, out.schema)
    if frame is no_docs:
        assert not rows


def test_groups_keep_rows_without_words_or_id(spark):
    kept = [r["doc_id"] for r in cp.keep_one_of_each_group(spark, odd_docs(spark), SF_DIR).collect()]
    # 6 and both rows of 7 are equal, 8 is near; one row of 14 stays; 1 to 5 and the rows without an id are apart
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 13, 14, None, None], key=str)
    assert len(odd_rows()) == len(kept) + 4
