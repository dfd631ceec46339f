"""The corpus pipeline: from raw documents to packed sequences, five stages with one operator each.

Every stage takes all that the one before kept and, but for the last, returns the columns of ``documents``. Nulls in
any column, empty tables, repeated rows and columns beside the known ones are carried along as each
stage's function says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import mixing, ngram_join, packing, pii, quality_classifier
from larkspur.llm.queries import MIX_EXPONENTS, mix_dimensions, tokenizer_path
from larkspur.session import cut_lineage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from all labels of documents at hand, does not reject.

    A null text is judged as an empty one. Without any label nothing is rejected.
    """
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_classifier.score(model, F.col("text")) >= 0.5)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word n-grams, similarity 0.8 or more) the document with the smallest id.

    Documents without words, and those without an id, belong to no group and stay. Of several rows with one id one
    stays: that whose text has the smallest hash.
    """
    groups = ngram_join.near_duplicates(docs, ngram_join.Threshold(words=5, percent=80))
    kept = (
        groups.where("doc_id is not null").groupBy(F.col("doc_id").alias("_kept_id"))
        .agg(F.min("component_id").alias("_first"), F.count("*").alias("_times")).where("_first = _kept_id")
    )
    chosen = docs.join(cut_lineage(spark, kept.drop("_first"), "kept"), F.col("doc_id") == F.col("_kept_id"))
    once = chosen.where("_times = 1").select(*docs.columns)
    row = F.struct(F.xxhash64("text").alias("_order"), *docs.columns)
    several = chosen.where("_times > 1").groupBy("_kept_id").agg(F.min(row).alias("_row"))
    return once.unionByName(several.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])).unionByName(docs.where("doc_id is null"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` is counted anew. A null text stays null."""
    clean = pii.redacted(F.col("text"))
    return docs.withColumn("text", clean).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics come near to flatter shares; see ``mixing.mix``."""
    mixed = mixing.mix(docs, mix_dimensions(), MIX_EXPONENTS)
    return mixed.where("kept").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens; see ``packing.pack``."""
    return packing.pack(docs, tokenizer_path(), keep_ids=False)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("personal data", hide_personal_data),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage before is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(spark, stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
