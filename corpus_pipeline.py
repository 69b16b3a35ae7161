"""Training-data pipeline over ``documents``.

Five stages: the quality classifier rejects documents, common lines go, one
document of each near-duplicate group stays, sources are sampled to target
weights, and what is left becomes token ids.  Each stage works on all that its
predecessor kept; its result is written as Parquet and read again.

Defined results: an empty table passes through; a null or empty text is
rejected by the classifier; a document of which no word is left when the common
lines are gone leaves with them; a ``doc_id`` with several rows is kept by a stage if the operator keeps
any of them; extra columns of the documents pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import bpe, kneser_ney, line_dedup, mixing, ngram_join
from stakeflow.llm.tables import materialise, read


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is among ``ids``."""
    ids = ids.select(F.col("doc_id").alias("kept_id"))
    return docs.join(ids.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram model accepts."""
    return _only(docs, kneser_ney.quality(docs, read(spark, sf_dir, "labels")).where("kept"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that three or more of them share; those with a word left."""
    out = line_dedup.without_common_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, 0.8)."""
    joined = ngram_join.ngram_join(docs, k=5, percent=80)
    return _only(docs, joined.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target shares of tokens."""
    return mixing.sample_to_targets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, ids, decoded, n_tokens``."""
    out = bpe.bpe_round_trip(docs, bpe.PUBLIC, carry=("source", "lang"))
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The language model and the tokenizer cannot be written in SQL; tests/llm/test_pipeline.py holds
#: the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
