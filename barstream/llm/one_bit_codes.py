"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Index: every vector x belongs to the nearest of at most ``CENTRES`` centres c (fitted on a bounded sample). Its residual
x - c is turned by a random rotation into ``bits`` dimensions; the code keeps the signs. With o the direction of the
residual and s the direction of its signs, <q, o> is estimated as <q, s> / <o, s>. The error of that estimate has a
standard deviation of at most |q| sqrt(1 / <o, s>^2 - 1) / sqrt(bits - 1), so a code and two scalars, |x - c| and
<o, s>, give an estimate with bounds. <q, s> is computed from packed bits: the rotated query is rounded to
``QUERY_BITS`` bits a component, and each bit plane costs an AND and a population count per 64 dimensions.

Search: every query gets a floor, its k-th best score over the sample, which its true k-th best cannot be below.
Centres whose ball cannot reach the floor are left out. Queries and vectors then meet in cells of bounded size (a part
of one centre's vectors, a group of queries): best estimates are computed exactly to raise the floor, and all vectors
whose upper bound (``SURENESS`` deviations) reaches it are reranked with exact scores. A cell returns k rows a query.
No cell holds more than ``CELL_VALUES`` values of vectors or ``CELL_QUERIES`` queries on average, however skewed the
centres are; no bucket has a cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.tables import record_batch, stored
from barstream.llm.vectors import finite, fit_centres, matrix, nearest_centre, rows_of, vector_sample

CENTRES = 32
QUERY_BITS = 4
SURENESS = 4.0           # deviations: an estimate is off by more with a chance of 6e-5, and only near the k-th score does it matter
CELL_VALUES = 1 << 20    # 16,384 vectors of 64 dimensions
CELL_QUERIES = 8192
PAIRS = 1 << 19          # of query and vector, estimated at once

_rotations: dict[int, np.ndarray] = {}


def bits_of(dimension: int) -> int:
    """Length of the code: four bits a component, in whole words of 64 bits, which halve the error of one bit a component."""
    return -(-4 * dimension // 64) * 64


def rotation(dimension: int) -> np.ndarray:
    """A random turn of ``dimension`` axes into ``bits_of(dimension)`` ones, the same on every machine."""
    if dimension not in _rotations:
        seen = np.random.default_rng(dimension).standard_normal((bits_of(dimension), dimension))
        basis, upper = np.linalg.qr(seen)
        _rotations[dimension] = basis * np.sign(np.diag(upper))
    return _rotations[dimension]


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, |x - c|, <o, s>) of the rows of ``vectors``; <o, s> is 1 where x = c."""
    residual = vectors - centre
    norm = np.linalg.norm(residual, axis=1)
    turned = residual @ rotation(vectors.shape[1]).T
    fit = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    with np.errstate(invalid="ignore", divide="ignore"):
        fit = np.where(norm > 0, fit / norm, 1.0)
    return np.packbits(turned > 0, axis=1), norm, np.clip(fit, 1e-12, 1.0)


def estimates(queries: np.ndarray, codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all queries with all coded vectors, and how far off they may be."""
    turned = queries @ rotation(queries.shape[1]).T
    bits = turned.shape[1]
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / ((1 << QUERY_BITS) - 1)
    step = np.where(step > 0, step, 1.0)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    rest = np.linalg.norm(turned - low[:, None] - levels * step[:, None], axis=1)
    words = np.ascontiguousarray(codes).view(np.uint64)
    shared = np.zeros((len(queries), len(codes)), np.uint32)
    for plane in range(QUERY_BITS):
        mask = np.packbits((levels >> plane) & 1, axis=1).view(np.uint64)
        for w in range(bits // 64):
            shared += np.bitwise_count(mask[:, w, None] & words[None, :, w]).astype(np.uint32) << np.uint32(plane)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    signed = 2 * (low[:, None] * ones + step[:, None] * shared) - turned.sum(axis=1)[:, None]
    size = np.linalg.norm(queries, axis=1)
    estimate = (queries @ centre)[:, None] + norm / (fit * np.sqrt(bits)) * signed
    spread = np.hypot(size[:, None] * np.sqrt(1 / fit ** 2 - 1) / np.sqrt(bits - 1), rest[:, None] / (fit * np.sqrt(bits)))
    rounding = 1e-9 * size[:, None] * (norm + np.linalg.norm(centre))
    return estimate, SURENESS * norm * spread + rounding


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up from the first component to the last in double precision."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each query: largest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    starts = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0]) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def search_cell(query_ids, queries, floors, ids, vectors, codes, norm, fit, centre, k: int):
    """(place of the query, id, score) of each query's k best vectors of a cell that are not below its floor."""
    found = []
    few = max(PAIRS // max(len(ids), 1), 1)
    for first in range(0, len(queries), few):
        own, q, floor = query_ids[first:first + few], queries[first:first + few], floors[first:first + few]
        estimate, off = estimates(q, codes, norm, fit, centre)
        other = own[:, None] != ids[None, :]
        estimate = np.where(other, estimate, -np.inf)
        if len(ids) > k:
            likely = np.argpartition(estimate, -k, axis=1)[:, -k:]
            row = np.repeat(np.arange(len(q)), k)
            scores = exact(q[row], vectors[likely.ravel()]).reshape(-1, k)
            scores = np.where(np.take_along_axis(other, likely, axis=1), scores, -np.inf)
            floor = np.maximum(floor, scores.min(axis=1))
        row, column = np.nonzero(estimate + off >= floor[:, None])
        for cut in range(0, len(row), PAIRS):
            r, c = row[cut:cut + PAIRS], column[cut:cut + PAIRS]
            score = exact(q[r], vectors[c])
            good = (score >= floor[r]) & other[r, c]
            found.append((first + r[good], ids[c[good]], score[good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    query, near, score = (np.concatenate(part) for part in zip(*found))
    best = _best(query, near, score, k)
    return query[best], near[best], score[best]


def _home(dimension: int, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of each row's centre; vectors of another dimension than the centres have one of their own at zero."""
    if len(centres) and centres.shape[1] == dimension:
        return nearest_centre(rows, centres)
    return np.full(len(rows), -dimension)


def _centre(number: int, dimension: int, centres: np.ndarray) -> np.ndarray:
    return centres[number] if number >= 0 else np.zeros(dimension)


def _by_dimension(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    rows = rows_of(column)
    lengths = np.array([len(r) for r in rows])
    for dimension in np.unique(lengths):
        places = np.flatnonzero(lengths == dimension)
        yield int(dimension), places, np.stack([rows[i] for i in places]).astype(np.float64)


def _index(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, places, rows in _by_dimension(batch.column(1)):
                home = _home(dimension, rows, centres)
                for number in np.unique(home):
                    own = home == number
                    codes, norm, fit = encode(rows[own], _centre(number, dimension, centres))
                    take = pa.array(places[own])
                    yield record_batch(centre=np.full(len(codes), number, np.int32), vec_id=batch.column(0).take(take),
                                       vector=batch.column(1).take(take), code=pa.array([c.tobytes() for c in codes], pa.binary()),
                                       norm=norm, fit=fit)
    return run


def _floors(centres: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, radius: dict[int, float], k: int):
    """Each query with its floor, once for every centre that may hold one of its k best."""
    numbers = np.array(sorted(n for n in radius if n >= 0), np.int64)
    reach = np.array([radius[n] for n in numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, places, rows in _by_dimension(batch.column(1)):
                ids = batch.column(0).to_numpy()[places]
                if len(centres) and centres.shape[1] == dimension:
                    floor = _kth(np.where(ids[:, None] == sample_ids[None, :], -np.inf, rows @ sample.T), k)
                    size = np.linalg.norm(rows, axis=1)
                    floor = floor - 1e-9 * size * np.linalg.norm(sample, axis=1).max()  # other order of additions
                    most = rows @ centres[numbers].T + size[:, None] * reach * (1 + 1e-9)
                    row, column = np.nonzero(most >= floor[:, None])
                    centre = numbers[column]
                elif -dimension in radius:
                    floor, row = np.full(len(rows), -np.inf), np.arange(len(rows))
                    centre = np.full(len(rows), -dimension)
                else:
                    continue
                yield record_batch(query_id=ids[row], query=batch.column(1).take(pa.array(places[row])), floor=floor[row],
                                   centre=centre.astype(np.int32))
    return run


def _search(centres: np.ndarray, k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if queries.num_rows and vectors.num_rows:
            rows, asked = matrix(vectors["vector"]).astype(np.float64), matrix(queries["query"]).astype(np.float64)
            codes = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
            number = vectors["centre"][0].as_py()
            own = queries["query_id"].to_numpy()
            query, near, score = search_cell(
                own, asked, queries["floor"].to_numpy(), vectors["vec_id"].to_numpy(), rows, codes, vectors["norm"].to_numpy(),
                vectors["fit"].to_numpy(), _centre(number, rows.shape[1], centres), k)
            return pa.table({"query_id": own[query], "vec_id": near, "score": score})
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of largest inner product with each row that ``is_query`` picks.

    ``is_query`` refers to columns of ``vectors``. A query is no candidate of its own; with fewer candidates all are
    returned, with none the query has no row. Ranks begin at 1; equal scores are in order of ids. Scores are inner products
    of the original vectors in double precision. Vectors that are null, empty, zero, or hold a null or non-finite component take no
    part, nor do rows without id. Of rows with one id the least vector counts, once. Vectors of different lengths have no inner
    product, so they are no candidates of each other. Other columns are ignored; an empty table gives no rows.
    """
    vector = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0)
    rows = stored(vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"),
                                               F.coalesce(is_query, F.lit(False)).alias("asks"))
                  .groupBy("vec_id").agg(F.min(F.struct("vector", "asks")).alias("row")).select("vec_id", "row.*"), "vectors")
    picked = vector_sample(rows, "vec_id", "vector")
    lengths = [len(v) for _, v in picked]
    usual = max(set(lengths), key=lengths.count) if lengths else 0
    sample_ids = np.array([i for i, v in picked if len(v) == usual], np.int64)
    sample = np.stack([v for _, v in picked if len(v) == usual]) if lengths else np.zeros((0, 0))
    centres = fit_centres(sample, CENTRES) if lengths else sample

    vector_type = rows.schema["vector"].dataType.simpleString()
    index = stored(rows.select("vec_id", "vector").mapInArrow(
        _index(centres), f"centre int, vec_id long, vector {vector_type}, code binary, norm double, fit double"), "codes")
    sizes = index.groupBy("centre").agg(F.max("norm").alias("radius"), F.sum(F.size("vector")).alias("values")).collect()
    n_queries = rows.where("asks").count()
    groups = -(-n_queries // CELL_QUERIES) or 1
    parts = F.element_at(F.create_map(*[F.lit(x) for row in sizes for x in (row["centre"], -(-row["values"] // CELL_VALUES))]), F.col("centre")) \
        if sizes else F.lit(1)

    asked = rows.where("asks").select("vec_id", "vector").mapInArrow(
        _floors(centres, sample_ids, sample, {row["centre"]: row["radius"] for row in sizes}, k),
        f"query_id long, query {vector_type}, floor double, centre int")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))) \
        .withColumn("team", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    held = index.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int")) \
        .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = asked.groupBy("centre", "part", "team").cogroup(held.groupBy("centre", "part", "team")).applyInArrow(
        _search(centres, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
