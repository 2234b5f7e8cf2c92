"""Quality classifier: a convolutional network over the bytes of the whole text, in numpy.

Bytes are embedded; filters of six bytes slide over the text two bytes at a time; their highest responses are pooled in
half chunks of 128 bytes, two neighbouring halves make one of the overlapping chunks; a hidden layer judges each chunk,
its units are max-pooled over all chunks of the document, and one logistic unit turns them into a probability.
Only the position with the highest response of a filter in a half chunk gets a gradient, so training costs little more
than scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import small_batches

WIDTH, HALF = 6, 64  # bytes of a filter; positions (two bytes each) of a half chunk
PARTS = WIDTH // 2
BLOCK = 512 * HALF
#: Most labelled rows that the network is fitted on.
FIT_ROWS = 4000


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of 16-bit byte pairs, each padded with zeros to whole half chunks, and the half chunks
    of each text (one at least, so that an empty text is a half chunk of zeros)."""
    data = [text.encode() for text in texts]
    halves = np.array([len(d) // (2 * HALF) + 1 for d in data], np.int64)
    padded = b"".join(d.ljust(2 * HALF * n, b"\0") for d, n in zip(data, halves.tolist()))
    return np.frombuffer(padded, np.uint8), halves


def windows(data: np.ndarray, halves: np.ndarray) -> list[np.ndarray]:
    """For every position its own byte pair, the next one and so on; zeros beyond the end of its text."""
    code, ends = data.view("<u2"), np.cumsum(halves) * HALF
    out = [code]
    for k in range(1, PARTS):
        later = np.concatenate([code[k:], np.zeros(k, "<u2")])
        for back in range(1, k + 1):
            later[ends - back] = 0
        out.append(later)
    return out


@dataclass
class Network:
    embedding: np.ndarray  # byte, dimension
    filters: np.ndarray  # place, dimension, filter
    filter_bias: np.ndarray
    hidden: np.ndarray  # filter, unit
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, seed: int, prior: float, dimension: int = 6, filters: int = 24, units: int = 16) -> Network:
        draw = np.random.default_rng(seed)
        some = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            some(256, dimension, scale=0.5), some(WIDTH, dimension, filters, scale=0.4),
            np.zeros(filters, np.float32), some(filters, units, scale=0.3), np.full(units, 0.1, np.float32),
            some(units, scale=0.1), np.array([prior], np.float32),
        )

    def tables(self) -> list[np.ndarray]:
        """For each pair of places, the response of every filter to every pair of bytes."""
        single = np.einsum("bd,pdf->pbf", self.embedding, self.filters)
        # Little-endian pairs: the first byte is the low one.
        return [
            (single[2 * k + 1][:, None, :] + single[2 * k][None, :, :]).reshape(65536, -1).astype(np.float32)
            for k in range(PARTS)
        ]

    def pooled(self, codes: list[np.ndarray], tables: list[np.ndarray], places: bool = False):
        """The highest response of each filter in each half chunk, and its place if asked for. Block by block."""
        tops, at = [], []
        for start in range(0, len(codes[0]), BLOCK):
            end = min(start + BLOCK, len(codes[0]))
            response = tables[0][codes[0][start:end]]
            for table, code in zip(tables[1:], codes[1:]):
                response += table[code[start:end]]
            response = response.reshape(-1, HALF, response.shape[1])
            if places:
                best = response.argmax(axis=1)
                at.append(best + (start + np.arange(len(best)) * HALF)[:, None])
                tops.append(np.take_along_axis(response, best[:, None, :], 1)[:, 0])
            else:
                tops.append(response.max(axis=1))
        top = np.concatenate(tops) + self.filter_bias
        return (top, np.concatenate(at)) if places else top

    def score(self, texts: list[str], tables: list[np.ndarray]) -> np.ndarray:
        """The probability of each text, however long."""
        data, halves = laid_out(texts)
        chunk, first, _ = self._chunks(np.maximum(self.pooled(windows(data, halves), tables), 0), halves)
        unit = np.maximum(chunk @ self.hidden + self.hidden_bias, 0)
        document = np.maximum.reduceat(unit, first, axis=0)
        return 1 / (1 + np.exp(-(document @ self.out + self.out_bias[0]).astype(np.float64)))

    @staticmethod
    def _chunks(top: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk i joins half chunks i and i + 1 of a text; its last one stands alone."""
        first = np.cumsum(halves) - halves
        follower = np.arange(len(top)) + 1
        last = first + halves - 1
        follower[last] = np.maximum(last - 1, first)
        return np.maximum(top, top[follower]), first, follower

    def gradients(self, data: np.ndarray, halves: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        codes = windows(data, halves)
        raw, place = self.pooled(codes, self.tables(), places=True)
        top = np.maximum(raw, 0)
        chunk, first, follower = self._chunks(top, halves)
        inner = chunk @ self.hidden + self.hidden_bias
        unit = np.maximum(inner, 0)
        owner = np.repeat(np.arange(len(halves)), halves)
        document = np.maximum.reduceat(unit, first, axis=0)
        chance = 1 / (1 + np.exp(-(document @ self.out + self.out_bias[0])))
        error = ((chance - labels) / len(labels)).astype(np.float32)
        to_document = error[:, None] * self.out
        is_top = (unit == document[owner]) & (inner > 0)
        ties = np.maximum(np.add.reduceat(is_top.astype(np.float32), first, axis=0), 1)
        to_inner = np.where(is_top, (to_document / ties)[owner], 0)
        to_chunk = to_inner @ self.hidden.T
        own = top >= top[follower]
        to_top = np.where(own, to_chunk, 0)
        np.add.at(to_top, follower, np.where(own, 0, to_chunk))
        to_top *= raw > 0
        return [
            *self._filter_gradients(codes, place, to_top), to_top.sum(0), chunk.T @ to_inner, to_inner.sum(0),
            document.T @ error, np.array([error.sum()]),
        ]

    def _filter_gradients(self, codes: list[np.ndarray], place: np.ndarray, to_top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = to_top.shape[1]
        used = np.nonzero(to_top)
        weight, at, filter_ = to_top[used], place[used], used[1]
        to_embedding, to_filters = np.zeros_like(self.embedding), np.zeros_like(self.filters)
        for k in range(WIDTH):
            byte = codes[k // 2][at].astype(np.int64) >> 8 * (k % 2) & 255
            by_byte = np.bincount(byte * count + filter_, weight, 256 * count).reshape(256, count)
            to_filters[k] = self.embedding.T @ by_byte
            to_embedding += by_byte @ self.filters[k].T
        return to_embedding, to_filters

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def train(texts: list[str], labels: list[int], steps: int = 900, batch: int = 48, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit with Adam over a fixed number of batches, so that the effort does not grow with the labels."""
    labels_ = np.array(labels, np.float32)
    positive = (labels_.sum() + 1) / (len(labels_) + 2)
    network = Network.new(seed, float(np.log(positive / (1 - positive))))
    if len(set(labels)) < 2:
        network.out[:] = 0
        return network
    draw = np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in network.parts()]
    square = [np.zeros_like(p) for p in network.parts()]
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < batch:
            order += draw.permutation(len(texts)).tolist()
        chosen, order = order[:batch], order[batch:]
        data, halves = laid_out([texts[i] for i in chosen])
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, m, v, g in zip(network.parts(), mean, square, network.gradients(data, halves, labels_[chosen])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def sample(labels: DataFrame, label: str, keep: Column, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled keys among those to keep, chosen by a hash of the key: a bounded table key, label."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & keep)
    chosen = known.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    return chosen.orderBy(F.xxhash64("_key"), "_key", "_label").limit(rows)


def fit(documents: DataFrame, labels: DataFrame, keep: Column, key: str = "doc_id", text: str = "text",
        label: str = "quality", rows: int = FIT_ROWS) -> Network:
    """Train on at most ``rows`` labelled documents (a documented bound). Null texts count as empty; with no label, or
    one kind only, the network answers with the smoothed share of label 1."""
    chosen = sample(labels, label, keep, rows, key)
    joined = documents.join(chosen, F.col(key) == F.col("_key")).select("_key", "_label", F.col(text).alias("_text"))
    found = sorted((r[0], r[2] or "", r[1]) for r in joined.collect())
    return train([text for _, text, _ in found], [label for _, _, label in found])


def scored(df: DataFrame, network: Network, text: str = "text", into: str = "score") -> DataFrame:
    """df with the probability of label 1 for each whole text in column ``into``; null texts count as empty."""
    small_batches(df.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = network.tables()
        for batch in batches:
            texts, out, group, held = [t or "" for t in batch], [], [], 0
            for text in texts:
                group.append(text)
                held += len(text)
                if held > 1 << 18:
                    out.append(network.score(group, tables))
                    group, held = [], 0
            if group:
                out.append(network.score(group, tables))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return df.withColumn(into, score(F.col(text)))
