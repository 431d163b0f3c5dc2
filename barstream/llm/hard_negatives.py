"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction (centres are fitted on a bounded sample). For a cluster with centre c whose members lie
within the angle b of it, no member u can score a candidate x higher than |u| |x| cos(max(0, angle(x, c) - b)). Candidates
are sorted by that bound without |u| once per cluster; all members walk the list from the top, in blocks of one matrix
product, and a member stops where its bound falls below what it still needs: certified, so nothing is missed.

The walk is taken twice. First for the positives: a member needs the k-th best score among rows of its label. Then
for the negatives of each positive: the k best scores of other labels that lie in the window below the positive's score;
a member needs the k-th best of these for its worst-served positive, or the window's lower end.

Anchors and candidates meet in cells of bounded size, a block of candidates and a team of anchors, so each cell sorts its own
part of a cluster's list; each returns k rows an anchor (or positive), which are ranked together afterwards. All scores
are exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.tables import stored
from barstream.llm.vectors import finite, fit_centres, matrix, vector_sample

CENTRES = 64
CELL_VALUES = 1 << 20   # 16,384 candidates of 64 dimensions
CELL_ANCHORS = 4096
FIRST_STEP = 256        # candidates of a list's first block; later blocks double
LARGEST = 1 << 26       # of a component, so that scores of 2,048 dimensions fit a long
SLACK = 1e-6            # of |u| |x|: rounding of angles


def scaled(vector: Column, factor: int = 256) -> Column:
    """Whole numbers floor(factor * x); beyond ``LARGEST`` either way they are held there."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * factor, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))


def _products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows, as doubles where these hold them exactly, else as longs."""
    largest = int(np.abs(rows).max(initial=0)) * int(np.abs(others).max(initial=0)) * max(rows.shape[1], 1)
    kind = np.float64 if largest < 1 << 53 else np.int64
    return (rows.astype(kind) @ others.astype(kind).T).astype(np.int64)


class SharedList:
    """Candidates in the order of what any member of a cluster can score them at most."""

    def __init__(self, members: np.ndarray, candidates: np.ndarray):
        units, self.sizes = _units(members)
        directions, lengths = _units(candidates)
        centre = units.sum(axis=0)
        centre = centre / (np.linalg.norm(centre) or 1)
        widest = np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0)
        apart = np.arccos(np.clip(directions @ centre, -1, 1)) - widest
        bound = lengths * (np.cos(np.clip(apart, 0, np.pi)) + SLACK)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.members, self.candidates = members, candidates

    def walk(self, needs, visit) -> int:
        """Visits blocks with ``visit(members, candidates, scores)`` until ``needs()``, the least score each member still has use for,
        is above all bounds. Returns how many scores were computed."""
        at, step, scored = 0, FIRST_STEP, 0
        while at < len(self.order):
            alive = np.flatnonzero(self.sizes * self.bound[at] + 0.5 >= needs())
            if not len(alive):
                break
            block = self.order[at:at + step]
            visit(alive, block, _products(self.members[alive], self.candidates[block]))
            scored += len(alive) * len(block)
            at, step = at + len(block), 2 * step
        return scored


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.astype(np.float64)
    sizes = np.linalg.norm(rows, axis=1)
    return rows / np.where(sizes > 0, sizes, 1)[:, None], sizes


_NONE = np.iinfo(np.int64).min


def _raise(top: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The k largest of ``top`` and ``scores`` in each row; the first is the least."""
    k = top.shape[1]
    return np.partition(np.concatenate([top, scores], axis=1), -k, axis=1)[:, -k:]


def _first(keys: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first rows of each key: largest score, then smallest id."""
    order = np.lexsort((ids, -scores, keys))
    starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0]) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def positives_of(shared: SharedList, ids, labels, candidate_ids, candidate_labels, k: int):
    """(member, candidate, score): each member's k first candidates of its own label, itself left out."""
    top = np.full((len(ids), k), _NONE)
    rows = []

    def visit(alive, block, scores):
        same = (labels[alive][:, None] == candidate_labels[block]) & (ids[alive][:, None] != candidate_ids[block])
        scores = np.where(same, scores, _NONE)
        top[alive] = _raise(top[alive], scores)
        m, c = np.nonzero(same & (scores >= top[alive].min(axis=1)[:, None]))
        rows.append((alive[m], block[c], scores[m, c]))

    shared.walk(lambda: top.min(axis=1), visit)
    return _collected(rows, lambda member, candidate: member, candidate_ids, k)


def negatives_of(shared: SharedList, labels, lowest, highest, candidate_ids, candidate_labels, k: int):
    """(member, slot, candidate, score): for each slot of a member the k first candidates of other labels with
    lowest <= score <= highest; a slot with lowest above highest takes none."""
    slots = lowest.shape[1]
    top = np.full((len(labels), slots, k), _NONE)
    rows = []

    def needs():
        need = np.maximum(top.min(axis=2), lowest).astype(np.float64)
        return np.where(lowest <= highest, need, np.inf).min(axis=1)

    def visit(alive, block, scores):
        other = labels[alive][:, None] != candidate_labels[block]
        for slot in range(slots):
            fits = other & (scores >= lowest[alive, slot][:, None]) & (scores <= highest[alive, slot][:, None])
            held = np.where(fits, scores, _NONE)
            best = top[alive, slot] = _raise(top[alive, slot], held)
            m, c = np.nonzero(fits & (held >= best.min(axis=1)[:, None]))
            rows.append((alive[m] * slots + slot, block[c], held[m, c]))

    shared.walk(needs, visit)
    key, candidate, score = _collected(rows, lambda key, _: key, candidate_ids, k)
    return key // slots, key % slots, candidate, score


def _collected(rows, key, candidate_ids, k):
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    owner, candidate, score = (np.concatenate(part) for part in zip(*rows))
    best = _first(key(owner, candidate), candidate_ids[candidate], score, k)
    return owner[best], candidate[best], score[best]


def _clusters(anchors: pa.Table, centres: np.ndarray):
    """Places of the anchors of each cluster and dimension with their matrix."""
    sizes = np.diff(anchors["vector"].combine_chunks().offsets.to_numpy())
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        rows = matrix(anchors["vector"].take(pa.array(places))).astype(np.int64)
        own = np.zeros(len(rows), np.int64)
        if len(centres) and centres.shape[1] == size:
            own = np.argmax(_units(rows)[0] @ centres.T, axis=1)
        for number in np.unique(own):
            yield size, places[own == number], rows[own == number]


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("candidate_id", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                       ("candidate_id", pa.int64()), ("score", pa.int64())])


def _cell(centres: np.ndarray, of_cluster, schema: pa.Schema):
    """Runs ``of_cluster`` on every cluster of a cell with the candidates of its dimension."""
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and candidates.num_rows:
            sizes = np.diff(candidates["vector"].combine_chunks().offsets.to_numpy())
            fitting: dict[int, tuple] = {}
            for size, places, rows in _clusters(anchors, centres):
                if size not in fitting:
                    own = candidates.take(pa.array(np.flatnonzero(sizes == size)))
                    fitting[size] = (own["id"].to_numpy(), own["label"].to_numpy(), matrix(own["vector"]).astype(np.int64))
                ids, labels, vectors = fitting[size]
                if len(ids):
                    found.append(of_cluster(SharedList(rows, vectors), anchors.take(pa.array(places)), ids, labels))
        return pa.concat_tables(found) if found else schema.empty_table()
    return run


def _positives(k: int):
    def run(shared: SharedList, anchors: pa.Table, ids, labels) -> pa.Table:
        own = anchors["id"].to_numpy()
        member, candidate, score = positives_of(shared, own, anchors["label"].to_numpy(), ids, labels, k)
        return pa.Table.from_arrays([pa.array(own[member]), pa.array(ids[candidate]), pa.array(score)], schema=_POSITIVE)
    return run


def _negatives(k: int, low: int, high: int):
    def run(shared: SharedList, anchors: pa.Table, ids, labels) -> pa.Table:
        own, positives = anchors["id"].to_numpy(), anchors["positives"].to_pylist()
        slots = max(map(len, positives))
        lowest, highest = np.ones((len(own), slots), np.int64), np.zeros((len(own), slots), np.int64)
        for i, row in enumerate(positives):
            for j, positive in enumerate(row):
                lowest[i, j], highest[i, j] = -(-low * positive["score"] // 100), high * positive["score"] // 100
        member, slot, candidate, score = negatives_of(shared, anchors["label"].to_numpy(), lowest, highest, ids, labels, k)
        chosen = [positives[m][s] for m, s in zip(member, slot)]
        return pa.Table.from_arrays(
            [pa.array(own[member]), pa.array([p["candidate_id"] for p in chosen], pa.int64()), pa.array([p["score"] for p in chosen], pa.int64()),
             pa.array(ids[candidate]), pa.array(score)], schema=_NEGATIVE)
    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                   id_col: str = "id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from vectors of whole numbers.

    An anchor (``is_anchor`` over columns of ``rows``) has as positives its first ``n_positives`` other rows of its label: higher
    inner product first, then smaller id. Negatives of a positive are the first ``n_negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. All that there are, if fewer; a positive without any has no row.

    Rows without id, label or vector, or with a null component, take no part. Of rows with one id the least (vector, label) counts,
    once. Vectors of different lengths have no inner product and do not meet. Components are expected within ``LARGEST``
    (see ``scaled``). Other columns are ignored; an empty table gives no rows.
    """
    vector = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(vector)
    table = stored(rows.where(usable).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                                             vector.cast("array<int>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
                   .groupBy("id").agg(F.min(F.struct("vector", "label", "asks")).alias("row")).select("id", "row.*"), "labelled")
    size = table.agg(F.sum(F.size("vector")).alias("values"), F.count_if("asks").alias("anchors")).first()
    blocks, teams = -(-(size["values"] or 0) // CELL_VALUES) or 1, -(-(size["anchors"] or 0) // CELL_ANCHORS) or 1
    picked = [v for _, v in vector_sample(table.where("asks"), "id", "vector")]
    usual = max(set(map(len, picked)), key=list(map(len, picked)).count) if picked else 0
    centres = fit_centres(np.stack([v for v in picked if len(v) == usual]), CENTRES, spherical=True) if picked else np.zeros((0, 0))

    candidates = table.select("id", "label", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")) \
        .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(teams - 1))))
    anchors = table.where("asks").select("id", "label", "vector", F.pmod(F.xxhash64("id"), F.lit(teams)).cast("int").alias("team"))

    def everywhere(some: DataFrame) -> DataFrame:
        return some.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def met(asking: DataFrame, of_cluster, schema: pa.Schema, text: str) -> DataFrame:
        return everywhere(asking).groupBy("block", "team").cogroup(candidates.groupBy("block", "team")).applyInArrow(
            _cell(centres, of_cluster, schema), text)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "candidate_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    positives = first(met(anchors, _positives(n_positives), _POSITIVE, "anchor_id long, candidate_id long, score long"), ["anchor_id"], n_positives)
    positives = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", "candidate_id", "score"))).alias("positives"))
    asking = stored(anchors.join(positives, "id"), "positives")
    found = met(asking, _negatives(n_negatives, low, high), _NEGATIVE,
                "anchor_id long, positive_id long, positive_score long, candidate_id long, score long")
    return first(found, ["anchor_id", "positive_id"], n_negatives).select(
        "anchor_id", "positive_id", "rank", F.col("candidate_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
