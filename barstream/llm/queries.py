"""Queries of the training-data operators over the synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm.collocations import collocations
from barstream.llm.decontamination import contamination
from barstream.llm.hard_negatives import hard_negatives, scaled
from barstream.llm.html_extraction import extract
from barstream.llm.jaccard_join import jaccard_components
from barstream.llm.one_bit_codes import nearest
from barstream.llm.oracle import ORACLE  # noqa: F401
from barstream.llm.packing import pack
from barstream.llm.passages import passage_groups
from barstream.llm.preferences import preference_format, swapped_answers
from barstream.llm.quality_classifier import held_out, score, train
from barstream.llm.quality_rules import quality_rules
from barstream.llm.suffix_dedup import repeated_bytes
from barstream.llm.tables import read_table
from barstream.llm.token_counts import token_counts
from barstream.llm.vectors import finite


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_format(swapped_answers(read_table(spark, sf_dir, "conversations")))
    return pairs.withColumnRenamed("pair_id", "conv_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    network = train(documents, labels.where(~held_out("doc_id")))
    scored = score(documents.select("doc_id", "text"), network)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_groups(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), scaled(F.col("embedding")).alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_quality_classifier, op3_jaccard_join, op4_substring_dedup, op5_token_counts, op6_packing, op7_benchmark_decontamination,
    op8_suffix_array_dedup, op9_html_extraction, op10_quality_rules, op11_nearest_neighbours, op12_phrase_collocations,
    op13_hard_negatives)}

