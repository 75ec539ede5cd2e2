"""The corpus pipeline: documents in, a weighted mix of clean documents out. Each stage's result is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectral_spark.llm import decontamination, mixing, ngram_join, secrets, toxicity
from spectral_spark.llm.common import bound_batches, stash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels of rows that are not held out.

    Null and empty texts match nothing and stay; repeated rows are judged alike; null ids and all other nulls pass. Without
    labels nothing is rejected. Columns besides COLUMNS are dropped, an empty table stays empty: so in all stages.
    """
    bound_batches(spark)
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*COLUMNS)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the smallest id, of equal ids that with the smallest digest of its text.

    Texts without words (null, empty) are classes of their own; of rows that repeat id and text one stays; a null id stays
    only where its class has no other.
    """
    bound_batches(spark)
    return ngram_join.keep_one(docs).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none and stay, as all do where the benchmark is empty; repeated rows are judged alike, and null ids are kept.
    """
    bound_batches(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars counted anew.

    A null text stays null, with a null n_chars; rows pass one by one, so repeated rows and null ids stay as they are.
    """
    bound_batches(spark)
    clean = secrets.redact(docs, secrets.train_models(secrets.labelled_tokens(docs)))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents by epoch, the last of each leaf cut to the tokens that its budget leaves.

    Null languages and sources are leaves of their own; texts without tokens (null, empty) are never taken; equal draws go
    by id, tokens and digest, and repeated rows are taken each for itself.
    """
    bound_batches(spark)
    mixed = mixing.mix_sources(docs, mixing.domain_of(F.col("source")), mixing.WEIGHTS, mixing.SHARE)
    text = mixing.cut_to_tokens(F.col("text"), F.col("mix_take"), F.col("mix_tokens"))
    return mixed.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS, "mix_domain", "mix_epoch", "mix_tokens", "mix_take")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_stage),
    ("ngram_join", duplicates_stage),
    ("decontamination", benchmark_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]

#: Learned scores and similarity classes have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage-{name}")
    return docs
