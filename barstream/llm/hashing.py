"""Words, shingles and rolling hashes of whole Arrow batches, computed with numpy on the UTF-8 bytes.

A batch is worked off in slices of about ``SLICE_BYTES`` so that memory does not depend on how many
texts an Arrow batch holds; one text is never cut. Null texts count as empty. All hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)                       # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

#: Bytes of words cut at white space: anything but blank, tab, line feed, vertical tab, form feed, return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of words of digits, lower-case letters and everything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0"):ord("9") + 1] = ALNUM[ord("a"):ord("z") + 1] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * SLICE_BYTES), base, np.uint64)
        have[0] = 1
        have = _powers[name] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows' texts in them) of successive slices."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


class Words:
    """The words of a slice: byte spans, the hash of each, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray):
        low = _LOWER[data]
        inside = in_word[low]
        edges = offsets[:-1][np.diff(offsets) > 0]  # first bytes of texts that have any
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[edges] = inside[edges]
        end[:-1] &= ~inside[1:]
        end[edges[1:] - 1] = inside[edges[1:] - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)  # text i has words first[i] to first[i + 1]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[low] * _power("base", _BASE, len(data)), out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * _power("inverse", _INVERSE, len(data) + 1)[self.starts]
                          + (self.ends - self.starts).astype(np.uint64))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words within one text, and the first word of each run."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        acc = np.zeros(n, np.uint64)
        for j in range(size):
            acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + self.hashes[j:j + n])
        text_end = np.repeat(self.first[1:], np.diff(self.first))[:n]
        fits = np.flatnonzero(np.arange(size, n + size) <= text_end)
        return acc[fits], fits


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size``-word runs; of all its words if there are fewer."""
    hashes, begins = words.windows(size)
    cuts = np.searchsorted(begins, words.first)
    sets = []
    for i in range(len(words.first) - 1):
        own = hashes[cuts[i]:cuts[i + 1]]
        if not len(own) and words.first[i] < words.first[i + 1]:
            acc = np.zeros(1, np.uint64)
            for h in words.hashes[words.first[i]:words.first[i + 1]]:
                acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + h)
            own = mix(acc + np.uint64(words.first[i + 1] - words.first[i]))
        sets.append(np.unique(own))
    return sets


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes, by its first byte."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("base", _BASE, len(data)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _power("inverse", _INVERSE, n))


def _window_extreme(values: np.ndarray, width: int, of: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = of.accumulate(blocks, axis=1).ravel()
    behind = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(behind[:n], ahead[width - 1:width - 1 + n])


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is the least of some run of ``width`` successive hashes (all of equal least ones).

    Whether a position is taken depends on the run alone, so equal runs give equal positions.
    """
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _window_extreme(hashes, width, np.minimum, np.iinfo(np.uint64).max)
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1:width - 1 + len(least)] = least
    return np.flatnonzero(_window_extreme(padded, width, np.maximum, 0) == hashes)


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's longs."""
    return h.view(np.int64)
