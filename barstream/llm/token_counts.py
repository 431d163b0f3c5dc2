"""Token counts by a two-tier lookup on the map side.

A first pass over all texts finds frequent pre-tokens: every task keeps its most frequent ones only, and these short
lists are summed. The ``TABLE_SIZE`` most frequent are encoded once and broadcast as a compact table of their lengths.
The second pass looks every pre-token up there, then in the worker's own cache, and encodes what neither knows. No pre-token of the corpus is shuffled; the lists summed are bounded per task, the
table is bounded altogether, and it only decides what is fast, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.hashing import text_slices
from barstream.llm.tables import record_batch, tokenizer_path
from barstream.llm.tokens import PieceEncoder, pre_tokens

TABLE_SIZE = 1 << 14
PER_TASK = 1 << 12
TOKEN_LIMIT = 2048


def slice_texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Rows and texts, slice by slice; null texts as empty ones."""
    for first, last, _, _ in text_slices(column):
        yield first, last, ["" if t is None else t for t in column.slice(first, last - first).to_pylist()]


def _frequent(per_task: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, _, texts in slice_texts(batch.column(0)):
                for text in texts:
                    counts.update(pre_tokens(text))
                if len(counts) > 32 * per_task:  # rare ones go, so memory is bounded
                    counts = Counter(dict(counts.most_common(8 * per_task)))
        top = counts.most_common(per_task)
        yield record_batch(piece=pa.array([p for p, _ in top], pa.string()), n=pa.array([n for _, n in top], pa.int64()))
    return run


def frequent_pre_tokens(documents: DataFrame, text_col: str, size: int = TABLE_SIZE, per_task: int = PER_TASK) -> list[str]:
    """The most frequent pre-tokens over all texts, at most ``size``."""
    counted = documents.select(text_col).mapInArrow(_frequent(per_task), "piece string, n long")
    top = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    return [r["piece"] for r in top.collect()]


class _LengthCounter:
    """The table's lengths first, then the worker's own cache."""

    def __init__(self, path: str, lengths: dict[str, int]):
        self._encoder = PieceEncoder(path)
        self._table = lengths

    def count(self, texts: list[str]) -> list[int]:
        cut = [pre_tokens(text) for text in texts]
        own = self._encoder.learn(set().union(*cut).difference(self._table))
        counts = []
        for pieces in cut:
            known = list(map(self._table.get, pieces))
            total = sum(filter(None, known))
            if None in known:
                total += sum(len(own[pieces[i]]) for i, n in enumerate(known) if n is None) >> 2
            counts.append(total)
        return counts


def _count(table, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _LengthCounter(path, table.value)
        for batch in batches:
            for first, last, texts in slice_texts(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first),
                     pa.array(counter.count(texts), pa.int64())], names=["id", "n_bytes", "n_tokens"])
    return run


def token_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, limit: int = TOKEN_LIMIT, table_size: int = TABLE_SIZE) -> DataFrame:
    """Per row of ``documents``: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null texts count as empty: no bytes, no tokens. Null ids and repeated rows are kept, one result each. An empty
    table gives an empty result. Ties among frequent pre-tokens do not matter to any count. Other columns are not read.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    frequent = frequent_pre_tokens(documents, text_col, table_size)
    encoded = PieceEncoder(path, table_size).learn(frequent)
    lengths = documents.sparkSession.sparkContext.broadcast({p: len(encoded[p]) >> 2 for p in frequent})
    id_type = documents.schema[id_col].dataType.simpleString()
    counted = documents.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(_count(lengths, path), f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
