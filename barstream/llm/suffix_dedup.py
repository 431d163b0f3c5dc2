"""Removal of repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Which strings of ``MIN_BYTES`` bytes occur twice is found in groups that hold every occurrence of a string:

1. Every string contains runs of ``SEED_BYTES`` bytes; the one with the least hash (the first of equal ones) is its
   seed. Equal strings have the same seed at the same place, and each start belongs to one seed. Seeds that occur
   once in the corpus, nearly all of clean text, go no further.
2. The starts around a repeated seed form a context: up to 100 bytes on the left, the seed, up to 100 on the right.
   Contexts are grouped by seed. Equal contexts are combined before the shuffle, so copies cost one row a task.
3. The distinct contexts of many groups are put into one text, the seed as a single symbol of its group. On the
   text's Burrows-Wheeler transform intervals are extended backwards, breadth first, which yields the common
   prefixes of neighbouring suffixes by increasing value; the expansion stops at the minimum length, and places
   still unset are those of repeated strings.

A seed with very many different contexts (a passage found everywhere, with other text around it) is divided by the
place of the start: strings that begin within ten bytes share ten times more, and those of one place are
equal or not. So no group grows with the corpus. Texts are told apart by two 64-bit hashes, places of a
seed by one; equal texts are handled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.hashing import _window_extreme, gram_hashes, signed, text_slices, winnow
from barstream.llm.tables import drop_stored, free_name, record_batch, stored

MIN_BYTES = 400
SLACK = 100            # bytes a string has besides its seed, at most: the longer the seed, the more there are
STRATUM = 10           # starts of one stratum when a seed is divided
GROUP_CONTEXTS = 4096  # more contexts of one seed are divided
TEXT_SYMBOLS = 400_000  # of one transform, about
SEEN_TEXTS = 200_000

_KEYS = ["k1", "k2"]


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text"))


def _seeds(min_bytes: int, seed_bytes: int):
    """(seed, text, place) of every seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(2)):
                keys = [c.slice(first, last - first).to_numpy() for c in batch.columns[:2]]
                hashes, places, rows = [], [], []
                for i in range(last - first):
                    key = (int(keys[0][i]), int(keys[1][i]))
                    if offsets[i + 1] - offsets[i] < min_bytes or key in seen:
                        continue
                    if len(seen) >= SEEN_TEXTS:
                        seen.clear()
                    seen.add(key)
                    grams = gram_hashes(data[offsets[i]:offsets[i + 1]], seed_bytes)
                    place = winnow(grams, min_bytes - seed_bytes + 1)
                    hashes.append(grams[place]), places.append(place), rows.append(np.full(len(place), i))
                if rows:
                    row = np.concatenate(rows)
                    yield record_batch(seed=signed(np.concatenate(hashes)), k1=keys[0][row], k2=keys[1][row],
                                       place=np.concatenate(places).astype(np.int32))
    return run


def _starts_of_seeds(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds in use, and the first and last start that belongs to each."""
    least = _window_extreme(grams, width, np.minimum, np.iinfo(np.uint64).max)
    kept = winnow(grams, width)
    own = np.searchsorted(kept, np.arange(len(least)))
    while (later := grams[kept[own]] != least).any():
        own[later] += 1
    first = np.flatnonzero(np.diff(own, prepend=-1))
    return kept[own[first]], first, np.append(first[1:], len(least)) - 1


def _contexts(min_bytes: int, seed_bytes: int):
    """(seed, left, right, text, place) around the repeated seeds of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, text, places in zip(*(batch.column(i) for i in range(4))):
                raw = text.as_py().encode()
                grams = gram_hashes(np.frombuffer(raw, np.uint8), seed_bytes)
                seeds, low, high = _starts_of_seeds(grams, min_bytes - seed_bytes + 1)
                wanted = np.flatnonzero(np.isin(seeds, places.values.to_numpy()))
                for i in range(0, len(wanted), 5000):
                    part = wanted[i:i + 5000]
                    at, lo, hi = seeds[part], low[part], high[part]
                    n = len(part)
                    yield record_batch(
                        seed=signed(grams[at]),
                        left=pa.array([raw[a:b] for a, b in zip(lo, at)], pa.binary()),
                        right=pa.array([raw[a:b] for a, b in zip(at + seed_bytes, hi + min_bytes)], pa.binary()),
                        base=pa.array(np.zeros(n, np.int32)), k1=pa.array(np.full(n, k1.as_py())), k2=pa.array(np.full(n, k2.as_py())),
                        place=at.astype(np.int32))
    return run


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, in order of their first ``depth`` symbols at least (symbols are below 2^31)."""
    n = len(symbols)
    rank, length = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:max(n - length, 0)] = rank[length:]
        key = rank * (n + 2) + ahead
        order = np.argsort(key, kind="stable")
        length *= 2
        if length >= depth:
            return order
        rank[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0)


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each place on occur at another place as well.

    Breadth-first search over intervals of the suffix order: all suffixes that begin with one string. An interval
    is extended to the left by every symbol before its suffixes; that moves its rows, symbol by symbol, to where
    the longer strings stand. The row after a new interval gets the string's length as common prefix if none
    was found yet; only then is the interval extended further. After ``length`` rounds the rows without a value
    have longer common prefixes.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    before = symbols[order - 1]  # the transform
    moved = np.empty(n, np.int64)
    moved[np.argsort(before, kind="stable")] = np.arange(n)
    # Rows of the cyclic step behind the last suffix keep their place: their strings hold the closing separator.
    unset = np.ones(n + 1, bool)
    unset[0] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        widths = high - low
        rows = np.repeat(low - np.cumsum(widths) + widths, widths) + np.arange(widths.sum())
        owner = np.repeat(np.arange(len(low)), widths)
        to = moved[rows]
        sort = np.argsort(to)
        to, owner, symbol = to[sort], owner[sort], before[rows[sort]]
        begins = np.ones(len(to), bool)
        begins[1:] = (np.diff(to) != 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(begins)
        low, high = to[first], to[np.append(first[1:], len(to)) - 1] + 1
        new = unset[high]
        low, high = low[new], high[new]
        unset[high] = False
        if not len(low):
            break
    same = np.flatnonzero(unset[:n])  # rows equal to the row before
    found = np.zeros(n, bool)
    found[order[same]] = found[order[same - 1]] = True
    return found


def _expanded(slack: int, seed_bytes: int):
    """Spans, relative to the seed's place, of the repeated strings of each context.

    ``slack`` is how many bytes a string has besides its seed.
    """
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        parts, begins, at, group = [], [], 0, {}
        for seed, left, right, _, _, _ in rows:
            own = group.setdefault(seed, len(group))
            text = np.zeros(len(left) + len(right) + 2, np.int64)
            text[:len(left)] = np.frombuffer(left, np.uint8)
            text[len(left)] = 256 + own
            text[len(left) + 1:-1] = np.frombuffer(right, np.uint8)
            text[:-1] += 1
            parts.append(text), begins.append(at)
            at += len(text)
        found = repeated_starts(np.concatenate(parts), slack + 1) if len(group) < len(rows) else np.zeros(at, bool)
        spans = []
        for (_, left, right, base, multi, _), begin in zip(rows, begins):
            starts = len(left) + len(right) - slack + 1
            mark = np.ones(starts, bool) if multi else found[begin:begin + starts]
            edge = np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8))
            zero = base + len(left)
            spans.append([{"from": int(a) - zero, "to": int(b) - 1 - zero} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
        keep = [i for i, s in enumerate(spans) if s]
        return record_batch(seed=pa.array([rows[i][0] for i in keep], pa.int64()), context=pa.array([rows[i][5] for i in keep], pa.int64()),
                            base=pa.array([rows[i][3] for i in keep], pa.int32()), spans=pa.array([spans[i] for i in keep], _SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, symbols = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != held[-1][0] and symbols >= TEXT_SYMBOLS:
                    yield solve(held)
                    held, symbols = [], 0
                held.append(row)
                symbols += len(row[1]) + len(row[2]) + 2
        if held:
            yield solve(held)
    return run


_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _divided(contexts: DataFrame, slack: int) -> DataFrame:
    """Contexts of strings that begin within ``STRATUM`` bytes (within one, in the last step); what all of these share joins the seed."""
    width = STRATUM if slack >= STRATUM else 1
    lowest, highest = F.lit(slack) - F.octet_length("right"), F.octet_length("left")  # bytes of strings left of the seed
    by_stratum = contexts.withColumn("stratum", F.explode(F.sequence(
        F.floor(lowest / width).cast("int"), F.floor(highest / width).cast("int"))))
    first = F.col("stratum") * width
    near = F.least(first, F.lit(slack - (width - 1)))  # the last stratum shares less, so that as much is left as of the others
    most, least = F.least(first + width - 1, highest), F.greatest(first, lowest)
    right_shared = F.lit(slack - (width - 1)) - near
    cut = lambda c, begin, n: F.substring(c, begin, n)
    return by_stratum.select(
        F.xxhash64("seed", "stratum", cut("left", F.octet_length("left") - near + 1, near), cut("right", F.lit(1), right_shared)).alias("seed"),
        cut("left", F.octet_length("left") - most + 1, most - near).alias("left"),
        cut("right", right_shared + 1, F.lit(slack) - least - right_shared).alias("right"),
        (F.col("base") + near).cast("int").alias("base"), *_KEYS, "place")


def _repeats(contexts: DataFrame, slack: int, seed_bytes: int, used: list[DataFrame]) -> DataFrame:
    """(text, first and last repeated start) of all contexts; ``used`` gets the tables this is read from."""
    contexts = contexts.withColumn("context", F.xxhash64("left", "right"))
    owner = F.struct(*_KEYS, "place")
    distinct = stored(contexts.groupBy("seed", "left", "right", "base", "context").agg(F.min(owner).alias("low"), F.max(owner).alias("high"))
                      .select("seed", "left", "right", "base", (F.col("low") != F.col("high")).alias("multi"), "context"), "contexts-distinct")
    groups = distinct.groupBy("seed").agg(F.count("*").alias("n"), F.max("multi").alias("multi")).where("n > 1 or multi")
    crowded = groups.where(F.col("n") > GROUP_CONTEXTS).select("seed")
    some = slack > 0 and not crowded.isEmpty()
    solved = distinct.join(groups.where(F.col("n") <= GROUP_CONTEXTS).select("seed") if some else groups.select("seed"), "seed", "left_semi")
    marked = (solved.repartition("seed").sortWithinPartitions("seed").select("seed", "left", "right", "base", "multi", "context")
              .mapInArrow(_expanded(slack, seed_bytes), "seed long, context long, base int, spans array<struct<from:int,to:int>>"))
    marked = stored(marked, "marked")
    used += [distinct, marked]
    found = contexts.join(marked, ["seed", "context", "base"]).select(*_KEYS, "place", F.inline("spans")).select(
        *_KEYS, (F.col("place") + F.col("from")).alias("from"), (F.col("place") + F.col("to")).alias("to"))
    if some:
        slack_left = STRATUM - 1 if slack >= STRATUM else 0
        divided = _divided(contexts.drop("context").join(crowded, "seed", "left_semi"), slack)
        found = found.unionByName(_repeats(divided, slack_left, seed_bytes, used))
    return found


def _cut(min_bytes: int):
    """(text, bytes and runs removed, what is kept) of every text with repeated starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, kept, sums = [], [], [], []
            for text, spans in zip(batch.column(2), batch.column(3)):
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                gone = np.zeros(len(raw) + 1, np.int32)
                np.add.at(gone, spans.values.field(0).to_numpy(), 1)
                np.add.at(gone, np.minimum(spans.values.field(1).to_numpy() + min_bytes, len(raw)), -1)
                gone = np.cumsum(gone[:-1]) > 0
                rest = raw[~gone].tobytes()
                removed.append(int(gone.sum())), runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(rest.decode("utf-8", "ignore")), sums.append(hashlib.sha256(rest).hexdigest())
            yield record_batch(k1=batch.column(0), k2=batch.column(1), n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(runs, pa.int64()),
                               kept=pa.array(kept, pa.string()), kept_sha256=pa.array(sums, pa.string()))
    return run


def _cuts(texts: DataFrame, min_bytes: int, used: list[DataFrame]) -> DataFrame:
    """What to remove from each text (k1, k2) that has repeated strings; ``used`` gets the tables this is read from."""
    seed_bytes = max(min_bytes - SLACK, min_bytes // 2)
    # Computed twice rather than stored: seeds are many, and nearly all occur once.
    seeds = texts.select(*_KEYS, "text").mapInArrow(_seeds(min_bytes, seed_bytes), "seed long, k1 long, k2 long, place int")
    owner = F.xxhash64(*_KEYS, "place")
    repeated = seeds.groupBy("seed").agg(F.min(owner).alias("low"), F.max(owner).alias("high")).where(F.col("low") != F.col("high")).select("seed")
    places = seeds.join(repeated, "seed", "left_semi").groupBy(*_KEYS).agg(F.collect_set("place").alias("places"))
    some = stored(texts.select(*_KEYS, "text").join(places, _KEYS).dropDuplicates(_KEYS), "texts-with-seeds")
    contexts = stored(some.select(*_KEYS, "text", "places").mapInArrow(
        _contexts(min_bytes, seed_bytes), "seed long, left binary, right binary, base int, k1 long, k2 long, place int"), "contexts")
    used += [some, contexts]
    starts = _repeats(contexts, min_bytes - seed_bytes, seed_bytes, used)
    spans = starts.groupBy(*_KEYS).agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    return some.select(*_KEYS, "text").join(spans, _KEYS).select(*_KEYS, "text", "spans").mapInArrow(
        _cut(min_bytes), "k1 long, k2 long, n_removed long, n_spans long, kept string, kept_sha256 string")


def _copies(texts: DataFrame, min_bytes: int) -> DataFrame:
    """Texts that several rows have whole: every string in them occurs again."""
    return (texts.where(F.octet_length("text") >= min_bytes).groupBy(*_KEYS).agg(F.count("*").alias("rows"))
            .where("rows > 1").select(*_KEYS, F.lit(True).alias("copied")))


def repeated_bytes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per row of ``documents``: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    A byte is removed if a string of ``min_bytes`` bytes over it also starts elsewhere, in the same text or in that
    of another row, judged on the input. Null texts are empty. Repeated rows are copies, so long ones lose everything.
    Null ids are kept, an empty table gives no rows, other columns are not read.
    """
    texts = _keyed(documents, id_col, text_col)
    cuts = stored(_cuts(texts, min_bytes, used := []).drop("kept"), "cuts")
    drop_stored(*used)
    rows = texts.select("id", *_KEYS, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    joined = rows.join(_copies(texts, min_bytes), _KEYS, "left").join(cuts, _KEYS, "left")
    by_copies = lambda all_gone, otherwise: F.when(F.col("copied"), all_gone).otherwise(otherwise)
    nothing = F.lit(0).cast("long")
    return joined.select(
        F.col("id").alias(id_col), "n_bytes", by_copies(F.col("n_bytes"), F.coalesce("n_removed", nothing)).alias("n_removed"),
        by_copies(F.lit(1).cast("long"), F.coalesce("n_spans", nothing)).alias("n_spans"),
        by_copies(F.sha2(F.lit("").cast("binary"), 256), F.coalesce("kept_sha256", "whole")).alias("kept_sha256"))


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``documents`` with repeated strings cut out of their texts, all rows and columns kept. Characters of which only
    some bytes are left go too. Null texts stay null."""
    k1, k2, kept = (free_name(documents, name) for name in ("_k1", "_k2", "_kept"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = documents.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    texts = _keyed(documents, id_col, text_col)
    changes = stored(_cuts(texts, min_bytes, used := []).select(*_KEYS, "kept").join(_copies(texts, min_bytes), _KEYS, "full"), "changes").select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.when(F.col("copied"), "").otherwise(F.col("kept")).alias(kept))
    drop_stored(*used)
    return keyed.join(changes, [k1, k2], "left").select(
        *[F.coalesce(kept, text_col).alias(text_col) if c == text_col else F.col(c) for c in documents.columns])
