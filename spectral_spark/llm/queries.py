"""The queries opN_<name> and pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, hard_negatives, jpeg, licenses, mixing, prefix_trie, secrets, topk_search, toxicity, urls, warc
from .common import bound_batches, stash
from .ngram_join import ngram_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fifths of the corpus's tokens, drawn to the weights of a domain-language-source tree."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, mixing.domain_of(F.col("source")), mixing.WEIGHTS, mixing.SHARE)
    return mixed.select("doc_id", "mix_domain", "mix_epoch", "mix_tokens", "mix_take")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin no longer one, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train_models(secrets.labelled_tokens(docs))
    found = secrets.find_secrets(docs, model).select("doc_id", "base_spans", "all_spans")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"), secrets.listed(F.col("all_spans")).alias("spans"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digests of all documents, looked up among known licences."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of ten words of benchmark items."""
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a progressive JPEG, read back from the shared folder, and its tensor described."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    media = stash(jpeg.store_texts(docs).drop("text"), "media", "zstd")
    return jpeg.describe(media).drop("media")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for every page, written to an archive and read back."""
    records = warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five-word n-grams, similarity 0.8 or more."""
    return ngram_join(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, from all embeddings."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every query, from all embeddings."""
    return topk_search.nearest(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt on shared beginnings."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_chat, op3_secrets, op4_licenses, op5_urls, op6_toxicity, op7_decontamination, op8_jpeg, op9_warc, op10_ngram_join, op11_hard_negatives, op12_topk, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op2_chat": chat.ORACLE, "op4_licenses": licenses.ORACLE, "op5_urls": urls.ORACLE, "op9_warc": warc.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE, "op12_topk": topk_search.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE, "op7_decontamination": decontamination.ORACLE}
