"""A byte-level convolutional network in numpy that tells good texts from bad ones.

Every byte becomes a small vector. Learned filters run over ``WIDTH`` bytes every ``HOP`` bytes. A document is
covered by overlapping chunks; each filter's largest response in a chunk goes into the chunk's logit, and the mean
of the chunk logits gives one probability for the whole text.

The network is fitted on the driver on at most ``PER_CLASS`` labelled texts of each class, picked by a hash of the
id; that bound is a parameter. Both classes count alike while fitting; the odds of the labels are added after. Scoring runs in Arrow batches where the texts are read, without a shuffle, over
every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.hashing import text_slices

WIDTH, HOP = 8, 2
DIMS, FILTERS = 4, 16
CHUNK = 512              # bytes; chunks overlap by WIDTH - HOP, so no place for a filter is lost
PER_CLASS = 800
STEPS, RATE, BATCH = 1000, 0.02, 16


@dataclass
class ByteNetwork:
    embed: np.ndarray    # (256, DIMS); byte values in rows
    filters: np.ndarray  # (WIDTH * DIMS, FILTERS)
    bias: np.ndarray
    weights: np.ndarray  # (FILTERS,)
    shift: np.ndarray    # (1,)

    @staticmethod
    def start(seed: int = 0) -> ByteNetwork:
        r = np.random.default_rng(seed)
        return ByteNetwork(
            r.normal(0, 0.5, (256, DIMS)).astype(np.float32), r.normal(0, 0.3, (WIDTH * DIMS, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32), r.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, np.float32))

    def chunks(self, text: np.ndarray) -> np.ndarray:
        """The text's bytes as rows of overlapping chunks, the last one filled up with zero bytes."""
        step = CHUNK - WIDTH + HOP
        n = max(1, -(-(len(text) - WIDTH + HOP) // step))
        padded = np.zeros((n - 1) * step + CHUNK, np.uint8)
        padded[:len(text)] = text
        return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of every filter in every chunk, and its place."""
        n, places = len(chunks), (CHUNK - WIDTH) // HOP + 1
        vectors = self.embed[chunks].reshape(n, CHUNK * DIMS)
        strips = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH * DIMS, axis=1)[:, ::HOP * DIMS]
        response = (strips.reshape(n * places, WIDTH * DIMS) @ self.filters).reshape(n, places, FILTERS)
        return response, vectors

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        """One logit per text; a few chunks at a time, so that memory doesn't follow a text's length."""
        chunked = [self.chunks(t) for t in texts]
        counts = np.array([len(c) for c in chunked])
        every = np.concatenate(chunked)
        out = np.empty(len(every), np.float32)
        for i in range(0, len(every), 256):
            response, _ = self.pooled(every[i:i + 256])
            out[i:i + 256] = np.maximum(response.max(axis=1) + self.bias, 0) @ self.weights
        return np.add.reduceat(out, np.cumsum(counts) - counts) / counts + self.shift[0]

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> ByteNetwork:
        """Adam on the log loss, with as many texts of one class as of the other in every step."""
        r, parts = np.random.default_rng(seed), (self.embed, self.filters, self.bias, self.weights, self.shift)
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        classes = [np.flatnonzero(labels == v) for v in (0, 1)]
        for step in range(1, steps + 1):
            batch = np.concatenate([r.choice(c, BATCH // 2) for c in classes])
            gradients = self._gradients([texts[j] for j in batch], labels[batch])
            rate = RATE * min(1, step / 20) * min(1, 2 - 2 * step / (steps + 1))
            for p, g, m, v in zip(parts, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self

    def _gradients(self, texts, labels):
        total = [np.zeros_like(p) for p in (self.embed, self.filters, self.bias, self.weights, self.shift)]
        for text, label in zip(texts, labels):
            chunks = self.chunks(text)
            logit, kept = 0.0, []
            for i in range(0, len(chunks), 64):
                response, vectors = self.pooled(chunks[i:i + 64])
                place = response.argmax(axis=1)
                top = np.take_along_axis(response, place[:, None, :], 1)[:, 0] + self.bias
                logit += float((np.maximum(top, 0) @ self.weights).sum())
                kept.append((i, place, top, vectors))
            p = 1 / (1 + np.exp(-np.clip(logit / len(chunks) + self.shift[0], -30, 30)))
            error = np.float32((p - label) / len(texts))
            total[4] += error
            error /= np.float32(len(chunks))
            for i, place, top, vectors in kept:
                total[3] += error * np.maximum(top, 0).sum(0)
                slope = error * self.weights * (top > 0)                                   # (chunks, FILTERS)
                total[2] += slope.sum(0)
                at = place[:, :, None] * HOP * DIMS + np.arange(WIDTH * DIMS)              # (chunks, FILTERS, WIDTH * DIMS)
                strips = vectors[np.arange(len(place))[:, None, None], at]
                total[1] += np.einsum("cf,cfk->kf", slope, strips)
                back = slope[:, :, None] * self.filters.T[None]
                bytes_at = chunks[i:i + 64][np.arange(len(place))[:, None, None], place[:, :, None] * HOP + np.arange(WIDTH)]
                np.add.at(total[0], bytes_at.reshape(-1), back.reshape(-1, DIMS))
        return total


def labelled_sample(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    per_class: int) -> tuple[list[np.ndarray], np.ndarray]:
    """At most ``per_class`` texts of either label, by the hash of their ids."""
    picked = None
    for value in (0, 1):
        some = (labels.where(F.col(label_col) == value).select(F.col(id_col).alias("_id"), F.lit(value).alias("_label")).distinct()
                .orderBy(F.xxhash64("_id"), "_id").limit(per_class))
        picked = some if picked is None else picked.unionByName(some)
    rows = (documents.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
            .join(F.broadcast(picked), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
            .orderBy("_id", "_label").toArrow())
    return ([np.frombuffer(t.as_py().encode(), np.uint8) for t in rows["_text"]],
            rows["_label"].to_numpy().astype(np.float32))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS, steps: int = STEPS) -> ByteNetwork:
    """A fitted network. Rows with a null id or label teach nothing; with no labelled text the score is 0.5
    everywhere, with one class only it is near that class everywhere."""
    texts, wanted = labelled_sample(documents, labels.where(F.col(id_col).isNotNull()), id_col, text_col, label_col, per_class)
    network = ByteNetwork.start()
    if len(set(wanted.tolist())) < 2:
        network.weights[:] = 0
        network.shift[:] = 0 if not len(wanted) else (4 if wanted[0] == 1 else -4)
        return network
    network.fit(texts, wanted, steps)
    rows = {r[label_col]: r["n"] for r in labels.where(F.col(label_col).isin(0, 1)).groupBy(label_col).agg(F.count("*").alias("n")).collect()}
    network.shift += np.float32(np.log(rows[1] / rows[0]))
    return network


def score(documents: DataFrame, network: ByteNetwork, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``documents`` with a probability per row. Null texts are scored as empty ones; equal texts score alike;
    all columns are kept as they are, but a column named as the score is replaced."""
    rest = documents.drop(score_col)
    place = rest.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(place)):
                logits = network.logits([data[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(1 / (1 + np.exp(-logits.astype(np.float64))))],
                    names=[*part.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{fields}, `{score_col}` double")


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1
