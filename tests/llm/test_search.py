"""Nearest neighbours, hard negatives and collocations against plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barstream.llm import collocations as C
from barstream.llm import hard_negatives as H
from barstream.llm import one_bit_codes as O
from barstream.llm.vectors import fit_centres

VECTORS = "vec_id long, embedding array<float>, label int, score double, rank int, centre string, vector int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 7.0, 3, "c", 1) for i, v, label in rows], VECTORS).repartition(5)


@pytest.fixture(scope="module")
def rows():
    """Clustered and scattered vectors, copies, ties, repeated ids, other lengths, nulls, zeros and non-finite ones."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    out = [(i, (centres[i % 6] * (i % 3) + rng.normal(size=24)).astype(np.float32).tolist(), i % 4) for i in range(700)]
    out += [(700 + i, out[5][1], i % 4) for i in range(90)]                 # copies: ties
    out += [(800 + i, rng.normal(size=7).astype(np.float32).tolist(), 1) for i in range(25)]
    out += [(10, out[11][1], 0), (10, out[10][1], 2), (10, out[10][1], 2)]  # repeated ids
    out += [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [1.0] * 23 + [None], 1), (904, [float("nan")] * 24, 2),
            (905, [float("inf")] + [0.0] * 23, 3), (None, out[3][1], 1), (906, out[4][1], None), (920, [float(np.float32(1e30))] * 24, 1), (940, [float(np.float32(1e-30))] * 24, 2)]
    return out


def usable(rows, zero, labelled=False):
    kept = {}
    for i, v, label in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or (labelled and label is None) or (not zero and not any(v)):
            continue
        kept[i] = min(kept.get(i, (v, label)), (v, label), key=lambda row: (row[0], row[1] if labelled else 0))
    return kept


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


@pytest.mark.parametrize("cell_values, cell_queries", [(O.CELL_VALUES, O.CELL_QUERIES), (24 * 40, 30)])
def test_nearest_equals_brute_force(spark, rows, monkeypatch, cell_values, cell_queries):
    monkeypatch.setattr(O, "CELL_VALUES", cell_values)
    monkeypatch.setattr(O, "CELL_QUERIES", cell_queries)
    got = defaultdict(list)
    for r in O.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=15).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    kept, want = usable(rows, zero=False), {}
    for q, (v, _) in kept.items():
        if q % 20 == 0:
            scores = sorted((-dot(v, w), i) for i, (w, _) in kept.items() if i != q and len(w) == len(v))
            want[q] = [(n, i, -s) for n, (s, i) in enumerate(scores[:15], 1)]
    assert len(want) > 40
    assert dict(got) == want


def test_nearest_on_small_tables(spark):
    assert O.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert O.nearest(vectors(spark, [(20, [1.0, 2.0], 1)]), F.col("vec_id") % 20 == 0).count() == 0
    assert O.nearest(vectors(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]), F.col("vec_id") % 20 == 0).count() == 0
    two = O.nearest(vectors(spark, [(20, [1.0, 2.0], 1), (21, [-1.0, 2.0], 1)]), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in two] == [(20, 1, 21, 3.0)]


def test_bounds_hold_and_most_vectors_are_left_out():
    """Bounds of the estimates are kept (four deviations), and exclude most of the far vectors."""
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(4000, 64)), rng.normal(size=(50, 64))
    x, q = x / np.linalg.norm(x, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
    for centre in fit_centres(x[:500], 3):
        codes, norm, fit = O.encode(x, centre)
        assert codes.shape == (4000, 32) and (fit > 0.7).all()
        estimate, off = O.estimates(q, codes, norm, fit, centre)
        true = q @ x.T
        assert (np.abs(estimate - true) <= off).mean() > 0.9999
        floor = np.partition(true, -20, axis=1)[:, -20]
        assert (estimate + off >= floor[:, None]).mean() < 0.25


def test_a_centre_itself_has_an_exact_estimate():
    centre = np.arange(1.0, 9.0)
    codes, norm, fit = O.encode(np.stack([centre, centre + 1]), centre)
    estimate, off = O.estimates(np.ones((1, 8)), codes, norm, fit, centre)
    assert norm[0] == 0 and estimate[0, 0] == pytest.approx(36.0) and off[0, 0] < 1e-6


def mined(rows, positives=5, negatives=5, low=80, high=100):
    kept, out = usable(rows, zero=True, labelled=True), {}
    whole = {i: ([int(max(min(math.floor(256.0 * x), H.LARGEST), -H.LARGEST)) for x in v], label) for i, (v, label) in kept.items()}
    for a, (v, label) in whole.items():
        if a % 10:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (w, other) in whole.items() if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            fitting = [(n, j) for n, j, other in scores if other != label and low * -p <= 100 * -n <= high * -p]
            out[a, i] = [(rank, j, -p, -n) for rank, (n, j) in enumerate(fitting[:negatives], 1)]
    return {key: value for key, value in out.items() if value}


def integers(spark, rows):
    return vectors(spark, rows).where("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))").select(
        F.col("vec_id").alias("id"), "label", H.scaled(F.col("embedding")).alias("vector"), "score", "rank", F.lit(1).alias("block"), F.lit(2).alias("team"))


@pytest.mark.parametrize("cell_values, cell_anchors", [(H.CELL_VALUES, H.CELL_ANCHORS), (24 * 60, 7)])
def test_hard_negatives_equal_brute_force(spark, rows, monkeypatch, cell_values, cell_anchors):
    monkeypatch.setattr(H, "CELL_VALUES", cell_values)
    monkeypatch.setattr(H, "CELL_ANCHORS", cell_anchors)
    got = defaultdict(list)
    found = H.hard_negatives(integers(spark, rows), F.col("id") % 10 == 0)
    for r in found.orderBy("anchor_id", "positive_id", "rank").collect():
        got[r["anchor_id"], r["positive_id"]].append((r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]))
    want = mined([(i, v, label) for i, v, label in rows])
    assert len(want) > 200
    assert dict(got) == want


def test_hard_negatives_on_small_tables(spark):
    for some in ([], [(10, [1.0, 2.0], 1)], [(10, [1.0, 2.0], 1), (11, [1.0, 2.0], 1)], [(10, [1.0, 2.0], None)]):
        assert H.hard_negatives(integers(spark, some), F.col("id") % 10 == 0).count() == 0
    some = [(10, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [1.0, 0.0], 2), (13, [0.75, 0.0], 2), (14, [0.9, 5.0], 3)]
    got = H.hard_negatives(integers(spark, some), F.col("id") % 10 == 0).orderBy("rank").collect()
    assert [(r["positive_id"], r["negative_id"], r["negative_score"]) for r in got] == [(11, 12, 65536), (11, 14, 256 * 230)]


def test_walks_stop_early():
    """Members of a narrow cluster compute a small part of all scores, and get what the whole list gives."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32) * 100
    members = np.rint(centre + rng.normal(size=(20, 32)) * 5).astype(np.int64)
    candidates = np.rint(np.concatenate([centre + rng.normal(size=(300, 32)) * 20, rng.normal(size=(30_000, 32)) * 100])).astype(np.int64)
    top = np.full((20, 5), H._NONE)

    def visit(alive, block, scores):
        top[alive] = H._raise(top[alive], scores)

    scored = H.SharedList(members, candidates).walk(lambda: top.min(axis=1), visit)
    assert scored < 0.2 * 20 * len(candidates)
    assert (np.sort(top) == np.sort(members @ candidates.T)[:, -5:]).all()


def counted(docs, threshold, longest=5):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    return {p: c for p, c in f.items() if c >= threshold}, n


def best(docs, threshold, most, longest=5):
    f, n = counted(docs, threshold, longest)
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or any(g == lang and c >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for (g, q), c in f.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i): (p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(found)[:most], 1)}


@pytest.fixture(scope="module")
def sentences():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(12)] + ["New", "YORK", "Österreich", "ẞ", "日本", "a\x85b", "c\x1cd"]
    share = 1 / np.arange(1, len(words) + 1)
    docs = []
    for i in range(150):
        text = " ".join(rng.choice(words, 60, p=share / share.sum()))
        if i % 2:
            text += "  New \t York City hall opens, of the people; by the people. a a a a a"
        docs.append((["en", "de", None, "und", "en"][i % 5], text.replace(" w3 ", ".\n").replace(" w5 ", "\t ")))
    late = [("en", "only late words here") for _ in range(9)]
    return docs + [("en", docs[1][1])] * 60 + late + [("fr", None), ("fr", ""), (None, " \t\n"), ("it", "one two three"), ("en", "x y " * 3000)]


@pytest.mark.parametrize("shards, bits, threshold", [(4, 24, 8), (3, 7, 20), (1, 24, 30)])
def test_collocations_equal_brute_force(spark, sentences, shards, bits, threshold):
    """Any number of shards gives the same; a table that is too small (2^7 places) only cost work."""
    docs = spark.createDataFrame([(i, lang, text, 1, "p") for i, (lang, text) in enumerate(sentences)], "doc_id int, lang string, text string, k int, phrase string")
    got = {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"])
           for r in C.collocations(docs.repartition(6), threshold=threshold, most=25, shards=shards, places=1 << bits).collect()}
    want = best(sentences, threshold, 25)
    assert len(want) > 20
    assert got == want


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string, start int")
    assert C.collocations(empty).count() == 0
    some = spark.createDataFrame([(None, None, 1), ("en", "a b c", 2)], "lang string, text string, start int")
    assert C.collocations(some).count() == 0
    got = C.collocations(some, threshold=1).orderBy("lang", "rank").collect()
    assert [(r["lang"], r["phrase"], r["score"]) for r in got] == [("en", "a b c", 3000)]


def test_scores_beyond_64_bits_are_exact(spark, monkeypatch):
    """1000 a n passes 64 bits."""
    big = 3_000_000_000_000
    counts = spark.createDataFrame([("en", "", 0, 50 * big), ("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 11)],
                                   "lang string, phrase string, k int, total long")
    monkeypatch.setattr(C, "phrase_counts", lambda *_, **__: counts)
    (row,) = C.collocations(counts).collect()
    assert row["score"] == 1000 * (big - 11) * 50 * big // (big * (big + 7))


def test_phrase_hashes_are_those_of_windows(spark):
    import pyarrow as pa

    from barstream.llm.hashing import text_slices
    texts = pa.array(["New  York\tcity. of the", "x"])
    for _, _, data, offsets in text_slices(texts):
        pieces = C.Pieces(data, offsets, np.array([C._language("en"), C._language(None)], np.uint64))
        at, acc = np.arange(6), pieces.first_hashes()
        assert pieces.within(at, 2).tolist() == [0, 1, 3]
        pairs = pieces.extended(np.array([0, 1, 3]), acc[[0, 1, 3]], 2)
        assert pieces.phrases(np.array([0, 1, 3]), 2).to_pylist() == ["new york", "york city", "of the"]
        assert (pairs == C.phrase_hashes(["en"] * 3, pa.array(["new york", "york city", "of the"]))).all()
