"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words. Of every run of ``WINDOW - GRAM + 1`` successive ``GRAM``-word grams
the one with the least hash is kept as a fingerprint. The choice depends on the run alone, so a document and an
item that share a whole window share the fingerprint kept in it. Fingerprints of the documents that a fixed-size
bit table of the item fingerprints lets through are extended to the windows around them, and these windows are
joined with those of the items. An item of fewer words than a window is one window of all its words; such items
are looked up by their own length, again through the bit table.

Scale: texts are read once and never shuffled. Only windows near a fingerprint hit leave the map side; they are
joined by window hash, so rows grow with the contaminated words. The bit table has a fixed size whatever the
benchmark's; a fuller table lets more through, and the join after it is exact. Windows that many items share are
looked up by set: items with equal window lists need no pairs of documents and windows beyond one per hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.hashing import ALNUM, Words, signed, text_slices, winnow
from barstream.llm.tables import free_name, record_batch, stored

WINDOW = 10
GRAM = 5
TABLE_BITS = 24


def _in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def _fingerprints(words: Words, window: int, gram: int) -> np.ndarray:
    """First words of the kept grams of every text."""
    hashes, begins = words.windows(gram)
    cuts = np.searchsorted(begins, words.first)
    kept = [begins[a:b][winnow(hashes[a:b], window - gram + 1)] for a, b in zip(cuts[:-1], cuts[1:])]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _item_windows(window: int, gram: int):
    """(item row's windows, the fingerprints of its windows): kind 0 windows, 1 fingerprints, by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                words = Words(data, offsets, ALNUM)
                n_words = np.diff(words.first)
                item, size, code = [], [], []
                for m in sorted({min(int(n), window) for n in n_words} - {0}):
                    hashes, begins = words.windows(m)
                    text = np.searchsorted(words.first, begins, "right") - 1
                    whole = (n_words[text] == m) if m < window else n_words[text] >= m
                    item.append(text[whole]), code.append(hashes[whole])
                    size.append(np.full(int(whole.sum()), m))
                if not item:
                    continue
                item, size, code = np.concatenate(item), np.concatenate(size), np.concatenate(code)
                yield record_batch(item_id=batch.column(0).slice(first, last - first).take(pa.array(item)),
                                   size=pa.array(size, pa.int32()), code=signed(code), is_print=pa.array(np.zeros(len(item), bool)))
                begins = _fingerprints(words, window, gram)
                hashes, at = words.windows(gram)
                prints = hashes[np.searchsorted(at, begins)]
                yield record_batch(item_id=pa.nulls(len(prints), batch.schema.field(0).type),
                                   size=pa.array(np.full(len(prints), window), pa.int32()), code=signed(prints),
                                   is_print=pa.array(np.ones(len(prints), bool)))
    return run


def _bit_table(codes: DataFrame) -> np.ndarray:
    """Bits of the codes' leading bits; at most ``2 ** TABLE_BITS`` slots reach the driver."""
    slots = codes.select(F.shiftrightunsigned("code", 64 - TABLE_BITS).alias("s")).groupBy(
        F.shiftright("s", 3).alias("byte")).agg(F.expr("bit_or(1 << cast(s & 7 as int))").alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    rows = slots.toArrow()
    table[rows["byte"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint8)
    return table


def _document_windows(tables, short_sizes: list[int], window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, shorts = tables.value
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                words = Words(data, offsets, ALNUM)
                n_words = np.diff(words.first)
                begin, size, code = [], [], []
                hashes, at = words.windows(gram)
                known = _in_table(prints, hashes)
                if known.any():
                    # Only texts with a known gram are winnowed.
                    begins = _kept_known(words, hashes, at, known, window, gram)
                    near = np.unique(np.concatenate([begins - j for j in range(window - gram + 1)])) if len(begins) else begins
                    codes, starts = words.windows(window)
                    place = np.searchsorted(starts, near)
                    ok = place < len(starts)
                    ok[ok] = starts[place[ok]] == near[ok]
                    begin.append(near[ok]), code.append(codes[place[ok]]), size.append(np.full(int(ok.sum()), window))
                for m in short_sizes:
                    codes, starts = words.windows(m)
                    ok = _in_table(shorts, codes)
                    begin.append(starts[ok]), code.append(codes[ok]), size.append(np.full(int(ok.sum()), m))
                text = [np.searchsorted(words.first, b, "right") - 1 for b in begin]
                hits: list[list[dict]] = [[] for _ in range(last - first)]
                for t, b, s, c in zip(text, begin, size, code):
                    for i, j, k, h in zip(t.tolist(), (b - words.first[t]).tolist(), s.tolist(), signed(c).tolist()):
                        hits[i].append({"begin": j, "size": k, "code": h})
                rest = [batch.column(i).slice(first, last - first) for i in range(batch.num_columns) if i != 1]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n_words, pa.int64()), pa.array(hits, _HITS)],
                    names=[*(n for i, n in enumerate(batch.schema.names) if i != 1), "n_words", "hits"])
    return run


_HITS = pa.list_(pa.struct([("begin", pa.int32()), ("size", pa.int32()), ("code", pa.int64())]))


def _kept_known(words: Words, hashes, at, known, window: int, gram: int) -> np.ndarray:
    cuts = np.searchsorted(at, words.first)
    texts = np.unique(np.searchsorted(cuts, np.flatnonzero(known), "right") - 1)
    kept = []
    for i in texts:
        a, b = cuts[i], cuts[i + 1]
        chosen = winnow(hashes[a:b], window - gram + 1)
        kept.append(at[a:b][chosen[known[a:b][chosen]]])
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def contamination(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """Per row of ``documents``: its id, n_words, n_hit (words inside an occurrence of an item's window),
    items (sorted ids, as strings, of the items with occurring windows) and hits (begin, size of each).

    Null and empty texts have no words and no hits. Repeated rows are judged alike, each for itself; a null
    document id is kept. Items without words have no window; items with a null id count as one unnamed item
    that marks words but is not listed. Without documents the result is empty, without items nothing is hit.
    Other columns of either table are not read.
    """
    spark = documents.sparkSession
    codes = stored(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).mapInArrow(
        _item_windows(window, gram), f"item_id {items.schema[item_col].dataType.simpleString()}, size int, code long, is_print boolean"),
        "item-windows").distinct()
    prints = _bit_table(codes.where("is_print"))
    shorts = _bit_table(codes.where(~F.col("is_print") & (F.col("size") < window)))
    short_sizes = [r[0] for r in codes.where(~F.col("is_print") & (F.col("size") < window)).select("size").distinct().collect()]
    tables = spark.sparkContext.broadcast((prints, shorts))
    # The row number keeps equal rows apart; it is stored with them, so it is never computed twice.
    found = stored(
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            _document_windows(tables, sorted(short_sizes), window, gram),
            f"id {documents.schema[id_col].dataType.simpleString()}, n_words long, hits array<struct<begin:int,size:int,code:long>>")
        .withColumn("row", F.monotonically_increasing_id()), "document-windows")
    windows = codes.where(~F.col("is_print")).select("item_id", "size", "code")
    candidates = found.where(F.size("hits") > 0).select("row", F.inline("hits"))
    hits = stored(candidates.join(windows.select("size", "code").distinct(), ["size", "code"], "left_semi"), "window-hits")
    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("begin", "size"))).alias("spans"))
    listed = hits.select("row", "size", "code").distinct().join(windows, ["size", "code"]).where("item_id is not null")
    by_row = listed.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["begin"] + s["size"]).alias("upto"),
            (acc["n"] + F.greatest(F.lit(0), s["begin"] + s["size"] - F.greatest(acc["upto"], s["begin"]))).alias("n")))["n"]
    return (
        found.drop("hits").join(spans, "row", "left").join(by_row, "row", "left")
        .select(F.col("id").alias(id_col), "n_words", F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                F.coalesce("spans", F.array().cast("array<struct<begin:int,size:int>>")).alias("hits")))


def decontaminate(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``documents`` none of whose words is hit, all columns kept; rows are judged one by one, whatever their ids."""
    row = free_name(documents, "_row")
    numbered = stored(documents.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    hit = contamination(numbered, items, row, **options).where("n_hit > 0").select(row)
    return numbered.join(hit, row, "left_anti").select(*documents.columns)
