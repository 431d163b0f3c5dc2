"""Packing token sequences with shortest-pack-first over the length histogram.

Every document becomes its token ids and an end id; full sequences are cut off its front, the rest is one shorter
piece. Only the histogram of piece lengths (at most ``capacity`` rows) is planned on the driver: lengths longest
first, each into the packs with most room, kept as packing patterns with counts. Patterns are joined back to the
pieces by the rank of a piece among those of its length.

Scale: texts are tokenised once, where they are read. Pieces are small rows in a stored table. Ranks come from
counts per length and bucket, so a length that most pieces have is ranked in many tasks. The table of pattern
slots is bounded by the capacity, not by the corpus, and is broadcast.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.tables import record_batch, stored, tokenizer_path
from barstream.llm.token_counts import slice_texts
from barstream.llm.tokens import PieceEncoder

CAPACITY = 2048
END_ID = 1
RANKED_ROWS = 50_000  # pieces of one length that one task ranks, about


def _pieces(path: str, capacity: int, end: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        step = 4 * capacity
        for batch in batches:
            for first, last, texts in slice_texts(batch.column(1)):
                rows, starts, lengths, sums, totals = [], [], [], [], []
                for i, packed in enumerate(encoder.encode(texts)):
                    packed += end
                    for at in range(0, len(packed), step):
                        piece = packed[at:at + step]
                        rows.append(i), starts.append(at >> 2), lengths.append(len(piece) >> 2)
                        sums.append(zlib.crc32(piece)), totals.append(len(packed) >> 2)
                ids = batch.column(0).slice(first, last - first).take(pa.array(rows, pa.int64()))
                yield record_batch(id=ids, start=pa.array(starts, pa.int64()), length=pa.array(lengths, pa.int64()),
                                   ids_crc32=pa.array(sums, pa.int64()), doc_tokens=pa.array(totals, pa.int64()))
    return run


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, rank after the last, first sequence, offset) that hold every piece.

    Patterns are kept by room left. A length goes to the patterns with most room, the emptiest ones first; a
    pattern with more packs than needed is divided. New packs are opened only if none has room.
    """
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # room -> (packs, lengths in them)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs and r >= length), default=None)
            packs, inside = by_room[room].pop() if room is not None else (left, ())
            used = min(left, packs)
            if used < packs:
                by_room[room].append((packs - used, inside))
            by_room[(capacity if room is None else room) - length].append((used, (*inside, length)))
            left -= used
    slots, ranks, sequence = [], defaultdict(int), 0
    for _, patterns in sorted(by_room.items()):
        for packs, inside in patterns:
            offset = 0
            for length in inside:
                slots.append((length, ranks[length], ranks[length] + packs, sequence, offset))
                ranks[length] += packs
                offset += length
            sequence += packs
    return slots


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Null ids and repeated rows are documents of their own. Pieces of
    equal length are ranked by id, start and checksum; rows equal in these are interchangeable. An empty table
    gives no pieces. Other columns are not read.
    """
    spark = documents.sparkSession
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    id_type = documents.schema[id_col].dataType.simpleString()
    pieces = stored(documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(path, capacity, end_id.to_bytes(4, "little")),
        f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan_packs(histogram, capacity), "slot_length long, low long, high long, sequence long, offset long")

    buckets = 1 + sum(histogram.values()) // RANKED_ROWS
    bucket = F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(buckets))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (pieces.groupBy("length", bucket.alias("bucket")).agg(F.count("*").alias("n"))
              .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    within = Window.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32")
    ranked = (pieces.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(within) - 1)
              .join(counts, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before")))
    return ranked.join(
        F.broadcast(slots),
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
             (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")
