"""Hashing, word cutting, tokens and packing against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barstream.llm.hashing import ALNUM, NOT_SPACE, Words, text_slices, winnow
from barstream.llm.packing import pack, plan_packs
from barstream.llm.tables import tokenizer_path
from barstream.llm.token_counts import token_counts
from barstream.llm.tokens import PieceEncoder


def ascii_lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nAaBz09-é\x1cß", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    for pattern, inside in ((rb"[^\x20\x09-\x0D]+", NOT_SPACE), (rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ALNUM)):
        got, codes = [], {}
        for _, _, data, offsets in text_slices(pa.array(texts, pa.string())):
            found = Words(data, offsets, inside)
            for i in range(len(offsets) - 1):
                own = [bytes(data[a:b]).lower() for a, b in zip(found.starts[found.first[i]:found.first[i + 1]], found.ends[found.first[i]:found.first[i + 1]])]
                got.append(own)
                for w, h in zip(own, found.hashes[found.first[i]:found.first[i + 1]]):
                    assert codes.setdefault(w, h) == h
        assert got == [re.findall(pattern, ascii_lower(t)) for t in texts]
        assert len(set(codes.values())) == len(codes)


@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 9))
@settings(max_examples=80, deadline=None)
def test_winnow_keeps_the_least_of_every_run(values, width):
    kept = set(winnow(np.array(values, np.uint64), width).tolist())
    want = set()
    for i in range(len(values) - width + 1):
        run = values[i:i + width]
        want |= {i + j for j, v in enumerate(run) if v == min(run)}
    assert kept == want


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in texts]


def test_small_caches_give_the_librarys_ids(texts, ids):
    encoder = PieceEncoder(tokenizer_path("word_bpe_49k.json"), entries=20)
    for (_, text), want in zip(texts, ids):
        assert np.frombuffer(encoder.encode([text or ""])[0], "<u4").tolist() == want


@pytest.mark.parametrize("table_size", [0, 50, 1 << 14])
def test_token_counts(documents, no_documents, texts, ids, table_size):
    got = token_counts(documents, table_size=table_size, limit=100).collect()
    want = [(i, len((t or "").encode()), len(x), len(x) > 100) for (i, t), x in zip(texts, ids)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert token_counts(no_documents).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
@settings(max_examples=60, deadline=None)
def test_plan_holds_every_piece_once(histogram):
    room, ranks = defaultdict(list), Counter()
    for length, low, high, sequence, offset in plan_packs(histogram, 64):
        assert low == ranks[length] and high > low
        ranks[length] = high
        for k in range(high - low):
            room[sequence + k].append((offset, length))
    assert ranks == Counter(histogram) and sorted(room) == list(range(len(room)))
    for pieces in room.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_packing(documents, no_documents, texts, ids):
    rows = pack(documents, capacity=256).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 256
    want = defaultdict(Counter)
    for (i, _), x in zip(texts, ids):
        full = np.array([*x, 1], "<u4")
        for a in range(0, len(full), 256):
            part = full[a:a + 256]
            want[i][(a, len(part), zlib.crc32(part.tobytes()), len(full))] += 1
    assert {i: Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in p) for i, p in pieces.items()} == want
    assert pack(no_documents).count() == 0
