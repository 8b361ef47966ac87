"""Queries of the operators: thin calls over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import (ann_forest, line_dedup, metric_join, ngram_join, packing, pii, pivot_codes, quality,
                           sentencepiece, token_orc, toxicity, turn_repair, url_filter)
from storyloom.operators.materialize import new_path
from storyloom.sources.tables import table


def tokenizer_file(name: str) -> str:
    """A file of the public tokenizers that every machine has."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", "line_dedup.n_near",
                      F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op4_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann_forest.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "token-ids")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer_file("word_bpe_49k.json"))
    return token_orc.token_digest(spark, out)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        F.size("spans").cast("long").alias("n_spans"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list from the given tables: an event's user is the page whose host it is about; errors and
    sign-ups list and unlist the host, purchases and clicks its domain."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("user_id"),
                                                 url_filter.host_of("url").alias("host"))
    events = table(spark, sf_dir, "events").where("event_type in ('error', 'signup', 'purchase', 'click')") \
        .select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    exact = F.col("event_type").isin("error", "signup")
    return events.join(pages, "user_id").select(
        F.when(exact, "host").otherwise("domain").alias("kind"),
        F.when(exact, F.col("host")).otherwise(F.substring_index("host", ".", -2)).alias("key"),
        "at", F.col("event_type").isin("error", "purchase").alias("listed"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("fetched"))
    captures = table(spark, sf_dir, "pages").join(fetched, "page_id", "left") \
        .select(F.col("page_id").alias("capture_id"), "url", "fetched")
    return url_filter.evaluate(captures, list_entries(spark, sf_dir)) \
        .select(F.col("capture_id").alias("page_id"), "host", "fetched", "blocked", "n_active", "since")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.coded_digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turn_repair.repair(turn_repair.damage(rows), rows)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.links_and_components(table(spark, sf_dir, "embeddings"), threshold=0.9)


REGISTRY = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_best_fit_packing, op3_line_dedup, op4_ann_forest, op5_quality_rules,
    op6_token_orc, op7_toxicity, op8_url_filter, op9_sentencepiece, op10_pii,
    op11_vector_codes, op12_conversation_repair, op13_embedding_near_dedup)}
