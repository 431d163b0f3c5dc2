"""Jaccard groups, repeated bytes, passages and decontamination against brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barstream.llm import jaccard_join, suffix_dedup
from barstream.llm.decontamination import contamination, decontaminate
from barstream.llm.graph import components
from barstream.llm.jaccard_join import adaptive_prefix, jaccard_components, near_copies_removed
from barstream.llm.passages import _SALTS, compact_windows, near_duplicate_passages, passage_groups
from barstream.llm.hashing import mix
from barstream.llm.tables import stored


def lowered_words(text, pattern=rb"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def shingles(text, size):
    w = lowered_words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def grouped(texts, size, percent):
    """(id, set size, component) of every row, by comparing all rows."""
    sets = [shingles(t, size) for _, t in texts]
    group = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            same_id = texts[i][0] is not None and texts[i][0] == texts[j][0]
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]) and (same_id or True):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for (i, _), g in zip(texts, group):
        least[g].append(i)
    small = {g: min((i for i in v if i is not None), default=None) for g, v in least.items()}
    return [(i, len(s), small[g]) for (i, _), s, g in zip(texts, sets, group)]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_groups(documents, no_documents, texts, size, percent):
    got = jaccard_components(documents, shingle_words=size, percent=percent)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, grouped(texts, size, percent)))
    assert jaccard_components(no_documents).count() == 0


def test_links_beyond_the_leaders(spark):
    """Chains of near copies: most members are too far from any one leader."""
    from tests.llm.conftest import words
    chains = []
    for c in range(4):
        w = words(150, 50 + c).split()
        for step in range(12):
            chains.append((c * 100 + step, " ".join(w)))
            w[step * 12] = f"new{step}"
    frame = spark.createDataFrame(chains, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_components(frame).collect()}
    assert got == {i: c for i, _, c in grouped(chains, 3, 90)}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_large_family(spark, size, percent):
    """Copies of one text with other words, cuts and passages that several of them share."""
    import random
    from tests.llm.conftest import words
    r, base, common = random.Random(5), words(150, 90).split(), [words(4, 91 + k).split() for k in range(3)]
    texts = []
    for i in range(90):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4, 6])):
            w[r.randrange(len(w))] = f"other{r.randrange(40)}"
        for passage in r.sample(common, r.choice([0, 1, 1, 2])):
            w[r.choice([20, 60]):r.choice([20, 60])] = passage
        texts.append((i, " ".join(w[r.choice([0, 0, 1, 5]):])))
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = jaccard_components(frame, shingle_words=size, percent=percent).collect()
    want = grouped(texts, size, percent)
    assert len({c for _, _, c in want}) > 1 and sorted(map(tuple, got)) == sorted(want)


@given(st.sets(st.integers(0, 30), min_size=1, max_size=20), st.sets(st.integers(0, 30), min_size=1, max_size=20), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_prefixes_of_linked_sets_share_enough(x, y, seed):
    counts = np.random.default_rng(seed).integers(1, 50, 1 << 18)
    shift = np.uint64(1 << 46)  # buckets of their own
    sets = [np.array(sorted(s), np.uint64) * shift for s in (x, y)]
    (p, k), (q, n) = (adaptive_prefix(s, counts, 3.0, 60) for s in sets)
    if 100 * len(x & y) >= 60 * len(x | y):
        assert len(np.intersect1d(p, q)) >= min(k, n)


def test_near_copies_removed(documents, texts):
    kept = near_copies_removed(documents)
    assert kept.columns == documents.columns
    rows = grouped(texts, 5, 80)
    want = {i for i, _, c in rows if i == c and i is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(want) and got.count(None) == 1


def test_rows_are_removed_one_by_one(spark):
    from tests.llm.conftest import words
    near, other, hit = words(60, 1), words(60, 2), words(30, 3)
    rows = [(None, near), (None, near), (1, other), (2, other), (2, near), (None, ""), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_copies_removed(frame).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, other), (2, near), (None, ""), (None, "")]))
    rows = [(1, hit), (1, near), (None, hit), (None, other)]
    clean = decontaminate(spark.createDataFrame(rows, frame.schema), spark.createDataFrame([(9, hit)], "item_id long, text string"))
    assert sorted(map(repr, map(tuple, clean.collect()))) == sorted(map(repr, [rows[1], rows[3]]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(201, 260)] + [(5, 5), (300, None), (400, 401), (401, 400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 200 for k in range(200, 260)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@given(st.lists(st.integers(1, 3), min_size=4, max_size=60), st.integers(1, 8), st.integers(2, 9))
@settings(max_examples=100, deadline=None)
def test_repeated_starts(values, length, part):
    symbols = np.array([v for i, v in enumerate(values) for v in ([v, 0] if i % part == part - 1 else [v])] + [0], np.int64)
    got = suffix_dedup.repeated_starts(symbols, length)
    runs = Counter(tuple(symbols[i:i + length]) for i in range(len(symbols) - length + 1))
    for i in range(len(symbols) - length + 1):
        run = tuple(symbols[i:i + length])
        if 0 not in run:
            assert got[i] == (runs[run] > 1)


def removed(texts, size):
    raw = [(i, (t or "").encode()) for i, t in texts]
    counts = Counter(b[j:j + size] for _, b in raw for j in range(len(b) - size + 1))
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - size + 1):
            if counts[b[j:j + size]] > 1:
                gone[j:j + size] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        yield i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("size,contexts", [(400, 4096), (60, 4096), (60, 2)])
def test_repeated_bytes(documents, no_documents, texts, size, contexts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_CONTEXTS", contexts)
    got = suffix_dedup.repeated_bytes(documents, min_bytes=size).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, removed(texts, size)))
    assert suffix_dedup.repeated_bytes(no_documents).count() == 0


@pytest.mark.parametrize("size", [400, 60])
def test_divided_seeds_with_starts_at_every_place(spark, size, monkeypatch):
    """Contexts of one passage that begin and end at every place, most in several texts, others at their own place."""
    from tests.llm.conftest import words
    monkeypatch.setattr(suffix_dedup, "GROUP_CONTEXTS", 3)
    passage, slack = words(200, 95)[:size + size // 4], size // 4
    rows = []
    for i in range(0, slack + 1, max(1, slack // 20)):
        rows += [(4 * i, words(10, 500 + i) + passage[i:] + words(10, 700 + i)), (4 * i + 1, words(9, 900 + i) + passage[i:] + words(9, 1100 + i))]
        rows += [(4 * i + 2, words(8, 1300 + i) + passage[:size + i] + words(8, 1500 + i)), (4 * i + 3, words(8, 1700 + i) + passage[i:i + size])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.repeated_bytes(frame, min_bytes=size).collect()
    assert sorted(map(tuple, got)) == sorted(removed(rows, size))


def test_without_repeats_keeps_rows_and_columns(documents, texts):
    out = suffix_dedup.without_repeats(documents, min_bytes=100)
    assert out.columns == documents.columns
    rows = {r.doc_id: r.text for r in out.collect()}
    assert out.count() == len(texts) and rows[5] is None and rows[1] == "" and rows[15] == dict(texts)[15]


def test_compact_windows_cover_every_stretch_once():
    r = np.random.default_rng(0)
    for _ in range(30):
        n, length = int(r.integers(1, 40)), int(r.integers(1, 8))
        x = r.integers(0, 12, n).astype(np.uint64)
        low, centre, high, _ = compact_windows(x, 0, length)
        hashes = mix(x ^ _SALTS[0])
        cover = {}
        for a, b, c in zip(low, centre, high):
            for i in range(a, b + 1):
                for j in range(max(b, i + length - 1), c + 1):
                    assert (i, j) not in cover
                    cover[i, j] = b
        for i in range(n):
            for j in range(i + length - 1, n):
                if (x[i:j + 1] == 0).any():
                    assert (i, j) not in cover
                else:
                    assert cover[i, j] == i + int(np.argmin(hashes[i:j + 1]))


def test_passages(documents, no_documents, texts):
    got = {r.doc_id: r for r in passage_groups(documents).collect()}
    runs = defaultdict(set)
    for row, (_, text) in enumerate(texts):
        w = lowered_words(text)
        for i in range(len(w) - 49):
            runs[tuple(w[i:i + 50])].add(row)
    want = {texts[row][0] for rows in runs.values() if len(rows) > 1 for row in rows}
    assert set(got) == want
    assert got[1].class_id == got[2].class_id == got[3].class_id == 1 and got[4].n_copies == 2
    assert got[8].class_id == got[9].class_id == 8 and got[8].n_passage_words == 89  # the last word has a full stop in one of them
    assert passage_groups(no_documents).count() == 0


def test_passages_that_differ_in_places(spark):
    from tests.llm.conftest import words
    passage = words(100, 70).split()
    edited = [w if i not in (30, 71) else "other" for i, w in enumerate(passage)]
    texts = [(1, words(90, 71) + " " + " ".join(passage) + " " + words(90, 72)), (2, words(50, 73) + " " + " ".join(edited)), (3, words(150, 74))]
    rows = near_duplicate_passages(spark.createDataFrame(texts, "doc_id long, text string"), hashes=8).collect()
    assert rows and all(r.similarity >= 0.8 for r in rows)


def passage_classes(texts):
    """Class of every text with a passage, by comparing all pairs with the settings of the query."""
    from barstream.llm import passages as p
    from barstream.llm.hashing import NOT_SPACE, Words
    raw = [t.encode() for _, t in texts]
    sequences, begins = p._shingles(Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), NOT_SPACE))
    parts = [sequences[a:b - 1] for a, b in zip(begins[:-1], begins[1:])]
    windows = [[compact_windows(x, f, p.LENGTH) for f in range(p.HASHES)] for x in parts]
    group, linked, spans = list(range(len(texts))), set(), defaultdict(set)
    for i in range(len(texts)):
        for j in range(i):
            for a, b, c, d, _ in p.passages_of(parts[i], parts[j], windows[i], windows[j], p.LENGTH, p.ENOUGH, p.PERCENT):
                linked |= {i, j}
                spans[i] |= set(range(a, b))
                spans[j] |= set(range(c, d))
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(texts[i][0] for i, h in enumerate(group) if h == g) for g in set(group)}
    return {texts[i][0]: least[group[i]] for i in linked}, {texts[i][0]: spans[i] for i in linked}


def test_passages_of_families_are_those_of_all_pairs(spark):
    """Variants of a passage that are too far from each other, and many passages that pairs of texts have in common."""
    import random
    from tests.llm.conftest import words
    r, base, texts = random.Random(3), words(60, 200).split(), []
    for i in range(100):
        w = list(base)
        if i:
            w[19 + i % 21] = f"other{i}"
        texts.append((i, " ".join([words(50, 300 + i), *w, words(50, 500 + i)])))
    common = [words(60, 700 + k) for k in range(25)]
    for i in range(60):
        mine = r.sample(common, 2)
        texts.append((1000 + i, " ".join([words(20, 800 + i), mine[0], words(30, 900 + i), mine[1], words(20, 1000 + i)])))
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    classes, spans = passage_classes(texts)
    got = passage_groups(frame).collect()
    assert {r.doc_id: r.class_id for r in got} == classes
    for row in got:  # every passage is in what was found, but for some words at its ends
        found = {w for begin, end in row.passages for w in range(begin, end)}
        assert len(spans[row.doc_id] - found) <= 10


def test_common_phrases_make_no_pairs_of_whole_texts(spark, monkeypatch):
    """Texts that share a sentence and no passage are told apart before their shingles are moved."""
    from barstream.llm import passages as p
    from tests.llm.conftest import words
    sentence, compared, inner = words(14, 40), [], p._compared
    texts = [(i, " ".join([words(30 + i, 1100 + i), sentence, words(80 - i, 1300 + i)])) for i in range(60)]
    texts += [(100, words(70, 5)), (101, words(70, 5) + " more"), (102, words(20, 6) + " " + words(70, 5))]
    monkeypatch.setattr(p, "_compared", lambda pairs, *rest: (compared.append(pairs.count()), inner(pairs, *rest))[1])
    got = {r.doc_id: r.class_id for r in passage_groups(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()}
    assert got == {100: 100, 101: 100, 102: 100}
    assert sum(compared) <= len(texts) + 10


def test_met_pairs_are_those_with_a_stretch_in_common(monkeypatch):
    from barstream.llm import passages as p
    r = np.random.default_rng(1)
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(p, "MET_PAIRS", block)
        for _ in range(30):
            n = int(r.integers(0, 30))
            centre = np.sort(r.integers(0, 40, n))
            low, high, function = centre - r.integers(0, 9, n), centre + r.integers(0, 9, n), r.integers(0, 3, n)
            want = {(i, j) for i in range(n) for j in range(i + 1, n) if function[i] != function[j]
                    and max(low[i], low[j]) <= min(centre[i], centre[j]) and max(centre[i], centre[j]) <= min(high[i], high[j])}
            got = list(zip(*(x.tolist() for x in p.met_pairs(low, centre, high, function))))
            assert len(got) == len(want) and set(got) == want


def test_shared_min_hashes_over_batches():
    import pyarrow as pa
    from barstream.llm import passages as p
    r = np.random.default_rng(2)
    for _ in range(40):
        rows = sorted((int(c), int(n), int(x)) for c, n, x in r.integers(0, [6, 3, 3], (int(r.integers(1, 40)), 3)))
        cuts = [0, *sorted(r.integers(0, len(rows) + 1, 4).tolist()), len(rows)]
        batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows[a:b]], pa.int64()) for k in range(3)], names=["code", "node", "place"])
                   for a, b in zip(cuts, cuts[1:])]
        got = [tuple(x.values()) for batch in p._shared(iter(batches)) for x in batch.to_pylist()]
        assert got == sorted({x for x in rows if len({n for c, n, _ in rows if c == x[0]}) > 1})


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (4, "..."),
         (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (None, "nameless item of three"), (10, "Über 日本 text")]
HITS = [(1, "x alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda y"), (2, "a short-item here and a short item"), (3, None), (4, ""),
        (5, "beta gamma delta"), (None, "short item"), (6, "the nameless item of three"), (7, "ein über 日本 text"), (8, "short " * 400), (9, "no hit")]


@pytest.mark.parametrize("window,gram", [(10, 5), (4, 2)])
def test_contamination(spark, window, gram):
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = lowered_words(t, pattern)
        m = min(window, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[a:a + m])].add(i)
    want = []
    for i, t in HITS:
        w, hit, items = lowered_words(t, pattern), set(), set()
        for m in {len(g) for g in windows}:
            for a in range(len(w) - m + 1):
                if tuple(w[a:a + m]) in windows:
                    hit |= set(range(a, a + m))
                    items |= windows[tuple(w[a:a + m])] - {None}
        want.append((i, len(w), len(hit), sorted(map(str, items))))
    documents = spark.createDataFrame([(i, t, "x", 3) for i, t in HITS], "doc_id long, text string, hits string, size int")
    items = spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id long, text string, code int")
    got = contamination(documents, items, window=window, gram=gram).drop("hits").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    clean = decontaminate(documents, items, window=window, gram=gram)
    assert clean.columns == documents.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, n, _ in want if not n and i is not None)
    assert contamination(documents, items.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(documents.limit(0), items).count() == 0


def test_followers_of_a_changed_copy_are_not_joined_in_pairs(spark, monkeypatch):
    """Copies share what their leader lacks: all link with the nearest of them, so few pairs are left to the join."""
    word = lambda kind, *i: f"{kind}{'x'.join(map(str, i))}"
    leader = [word("w", i) for i in range(100)]
    near = [[*leader[:90], word("near", k), *leader[91:]] for k in range(12)]
    copies = [[*leader[:92], *(word("shared", i) for i in range(4)), *(word("own", k, i) for i in range(4))] for k in range(40)]
    rows = [(i, " ".join(words)) for i, words in enumerate([leader, *near, *copies])]
    asked = []
    links = jaccard_join._links_of_followers
    monkeypatch.setattr(jaccard_join, "_links_of_followers", lambda pairs, *rest: asked.append(pairs.count()) or links(pairs, *rest))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=1)
    assert sorted(map(tuple, found.collect())) == sorted(grouped(rows, 1, 90))
    assert 0 < sum(asked) <= 3 * len(rows)


@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=60), st.sets(st.integers(0, (1 << 64) - 1), max_size=60))
def test_bits_differ_no_more_than_sets(x, y):
    bits = [jaccard_join._bits(np.array(sorted(s), np.uint64)).view(np.uint64) for s in (x, y)]
    assert len(bits[0]) * 64 == jaccard_join.TOKEN_BITS
    assert sum(int(w).bit_count() for w in bits[0] ^ bits[1]) <= len(x ^ y)


def test_seeds_of_shorter_strings_are_few():
    """A string of 220 bytes, as in the pipeline, has one seed in some fifty bytes, as one of 400 has."""
    assert suffix_dedup.SLACK == 100
    text = bytes(np.random.default_rng(5).integers(97, 123, 100_000, np.uint8)).decode()
    batch = suffix_dedup.record_batch(k1=[1], k2=[1], text=[text])
    seeds = sum(b.num_rows for b in suffix_dedup._seeds(220, 120)(iter([batch])))
    assert seeds < 2.2 * len(text) / suffix_dedup.SLACK


def test_tables_in_between_are_dropped(spark, documents, monkeypatch):
    made = []
    keep = lambda df, label: made.append((label, stored(df, label))) or made[-1][1]
    monkeypatch.setattr(suffix_dedup, "stored", keep)
    rows = suffix_dedup.repeated_bytes(documents, min_bytes=220).count()
    assert rows == documents.count()
    there = lambda table: any(os.path.exists(f.removeprefix("file://")) for f in table.inputFiles())
    assert [label for label, table in made if there(table)] == ["cuts"]
