"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm.decontamination import decontaminate
from barstream.llm.jaccard_join import near_copies_removed
from barstream.llm.packing import pack
from barstream.llm.quality_classifier import held_out, score, train
from barstream.llm.suffix_dedup import without_repeats
from barstream.llm.tables import free_name, read_table, stored

#: Fifty words of the texts have as many bytes or more.
PASSAGE_BYTES = 220


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are likelier bad than good, as learnt from the labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    column = free_name(docs, "_score")
    scored = score(docs, train(docs, labels), score_col=column)
    return scored.where(F.col(column) >= 0.5).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles link at a similarity of 0.8."""
    return near_copies_removed(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of ``PASSAGE_BYTES`` bytes that occur more than once out of the texts."""
    return without_repeats(docs, min_bytes=PASSAGE_BYTES)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a ten-word window of a benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one row per piece."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("n-gram jaccard join", near_copies), ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", benchmark_free), ("packing", packed)]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
