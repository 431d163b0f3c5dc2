"""Token ids of texts by a public tokenizer that drops white space, through caches of pre-tokens.

The tokenizer lower-cases, cuts a text into pre-tokens and encodes each by itself. Texts of plain letters, digits and
signs are cut into pre-tokens here, and only those that no cache has reach the library, many in one call. In other
texts every run without white space that has other characters goes to the library as it is, under its own cache entry.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

CACHE_ENTRIES = 400_000  # of a generation; two are kept

# Characters whose pre-tokens are found here: printable ASCII and the letters of Latin-1, which lower-case and
# normalise to one letter each.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile(r"[ -~\t\n\v\f\rÀ-ÖØ-öø-ÿ]*")
# The tokenizer's own pre-token pattern, on such characters; words come first, which is quicker and the same, as no
# two of the parts for words, contractions and digits begin alike. Fixed value but for that order.
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
# How byte-level tokenizers write a byte: printable Latin-1 signs stand for themselves, the others, in order, for the
# characters from 256 on.
_OTHER_BYTES = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(_OTHER_BYTES)}
# Pre-tokens on which the direct way to the model must agree with the library before it is used.
_PROBES = ["the", "retokenisation", "été", "größe", "ñandúà", "'s", "7", "***", "$%&", "zqxjkv", "ßùÿ"]
# Separators that Python's split() cuts at and the tokenizer does not.
_OTHER_SPACE = re.compile("[\x1c-\x1f]")
# What begins a special token.
_SPECIAL = "<|"
# Before a run or text that goes to the library as it is.
_RAW = "\0"


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, in order; parts that only the library can cut are one entry, marked by a zero."""
    if _PLAIN_TEXT.fullmatch(text) and _SPECIAL not in text:
        return _PIECES.findall(text.lower())
    if _OTHER_SPACE.search(text):
        return [_RAW + text]
    found = []
    for run in text.split():
        if _PLAIN.fullmatch(run) and _SPECIAL not in run:
            found += _PIECES.findall(run.lower())
        else:
            found.append(_RAW + run)
    return found


class PieceEncoder:
    """Packed ids (little-endian, four bytes each) of pre-tokens."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self._model = None
        if hasattr(self._tokenizer.model, "tokenize"):
            self._model = self._tokenizer.model
            if self._encoded(_PROBES) != self._library(_PROBES):
                self._model = None
        self._entries = entries
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Pre-tokens that were cut and lower-cased here go straight to the model; if that is not the library's way
        with them, joined by blanks and cut again after the ids that end a pre-token."""
        if self._model is not None:
            tokenize = self._model.tokenize
            signs = [p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_SIGNS) for p in pieces]
            return [array("I", [token.id for token in tokenize(p)]).tobytes() for p in signs]
        out: list[bytes] = []
        for i in range(0, len(pieces), 2000):
            part = pieces[i:i + 2000]
            packed = self._library([" ".join(part)])[0]
            stops = (np.flatnonzero(self._ends[np.frombuffer(packed, "<u4")]) + 1) * 4
            if len(stops) == len(part) and stops[-1] == len(packed):
                stops = stops.tolist()
                out += [packed[a:b] for a, b in zip([0, *stops[:-1]], stops)]
            else:
                out += self._library(part)
        return out

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """A table that has every one of ``pieces``; it holds no more entries than given, beyond those."""
        if len(self._new) > self._entries:  # those still in use come back from the last generation
            self._new, self._old = {}, self._new
        unknown = set(pieces).difference(self._new)
        if unknown:
            before = unknown.intersection(self._old)
            self._new.update((p, self._old[p]) for p in before)
            fresh = list(unknown - before)
            raw = [p for p in fresh if p[0] == _RAW]
            plain = [p for p in fresh if p[0] != _RAW]
            self._new.update(zip(plain, self._encoded(plain)))
            self._new.update(zip(raw, self._library([p[1:] for p in raw])))
        return self._new

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts, of one slice at a time."""
        cut = [pre_tokens(text) for text in texts]
        look_up = self.learn(set().union(*cut)).__getitem__
        return [b"".join(map(look_up, pieces)) for pieces in cut]
