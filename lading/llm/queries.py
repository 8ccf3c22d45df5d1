"""Registered queries of the training-data operators and their DuckDB oracles.

Each query is thin: it reads its whole table, applies the operator with its
production parameters and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.llm.oracles import ORACLE  # noqa: F401  (read by __spark_entry__)
from lading.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm import quality_rules as q
    led = q.apply_policy(q.ledger(read_table(spark, sf_dir, "documents")), q.POLICIES["default"])
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~q.passes(q.POLICIES["base"])).alias("base_failed"), "kept", "failure_bits")


@register("op2_ngram_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.ngram_join import jaccard_components
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register("op1_benchmark_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.decontaminate import contamination
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op8_pii_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.pii import ROW, key_of, pseudonymise
    return (pseudonymise(read_table(spark, sf_dir, "documents"), key_of(spark))
            .select(F.col(ROW)["doc_id"].alias("doc_id"), "text", "n_entities", "entities"))


@register("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.packing import packed_sequences
    return packed_sequences(read_table(spark, sf_dir, "documents"))


@register("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.substring_dedup import removed_spans
    # passages; frequent short lines are the operator's business, not a fault of the documents that hold them
    return removed_spans(read_table(spark, sf_dir, "documents"), often_lines=False)


@register("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.quality_classifier import scores
    held_out = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    found = scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), f"not ({held_out})")
    return found.select("doc_id", F.expr(held_out).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.rowmap import ROW
    from lading.llm.token_counts import token_counts
    return token_counts(read_table(spark, sf_dir, "documents")).select(F.col(ROW)["doc_id"].alias("doc_id"), "n_words", "n_tokens")


@register("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.secret_scan import scan
    return scan(read_table(spark, sf_dir, "documents"))


@register("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.lm_scoring import scores
    return scores(read_table(spark, sf_dir, "documents"), "crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")


@register("op11_filter_audit")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.filter_audit import audit
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), "source")


@register("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.conversation_repair import damage, repair
    return repair(damage(read_table(spark, sf_dir, "conversations")))


@register("op13_sharding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lading.llm.sharding import LAW, assign
    placed = assign(read_table(spark, sf_dir, "documents"), 24)
    return placed.select("*", F.lit(LAW).alias("law"), F.lit(None).cast("int").alias("grown_shard"))
