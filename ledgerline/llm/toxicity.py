"""Toxicity classifier with counterfactual regularisation.

A logistic model over what the distinct words of a whole text contain: each word itself and its letter groups of four.
Besides the loss on the labels it is penalised for every change of a document's score when an identity term in it is
swapped for another one (or for a neutral word); a document without such a term has one put in, then swapped. So the
terms themselves cannot carry weight, even where they are commoner in toxic documents. An L1 penalty clears all features
without clear evidence, and no weight is negative: harmless words neither add up in a long text nor outweigh an insult.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import sample
from .shared import Memory, small_batches

BUCKETS = 1 << 20
GROUP = 4
#: Most labelled rows that the model is fitted on.
FIT_ROWS = 5000
#: Entries that a step of the training works on at once: its temporary arrays are this long, not as long as all texts.
BLOCK = 1 << 18
WORD = re.compile(r"[^\W\d_]+")

#: The parts of an example, as columns.
SETS = ("every", "first", "second")

#: Terms that name groups of people, and neutral words in their place.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu",
    "buddhist", "atheist", "black", "white", "asian", "african", "latino", "arab", "european", "gay", "lesbian",
    "bisexual", "transgender", "straight", "immigrant", "immigrants", "refugee", "foreigner", "disabled", "blind",
    "deaf", "old", "young", "frauen", "ausländer", "femmes", "étrangers", "mujeres", "extranjeros",
)
NEUTRAL_TERMS = ("people", "person", "somebody", "leute", "gens", "gente")


def features(word: str) -> set[int]:
    marked = f"^{word}$"
    parts = {marked[i : i + GROUP] for i in range(len(marked) - GROUP + 1)} | {"=" + word}
    return {zlib.crc32(part.encode()) % BUCKETS for part in parts}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class Model:
    """Weights other than zero, by feature, and the bias."""

    weights: dict[int, float]
    bias: float
    known: Memory = field(default_factory=Memory, repr=False)
    active: dict[str, frozenset[int]] = field(default_factory=dict, repr=False)

    def logit(self, text: str) -> float:
        words = words_of(text)
        if self.known.make_room():
            self.active = {}
        unseen = [word for word in words if word not in self.known]
        for word in unseen:
            if hit := features(word) & self.weights.keys():
                self.active[word] = frozenset(hit)
        self.known.keep((word, None) for word in unseen)
        found = set().union(*(self.active[word] for word in words & self.active.keys()))
        return self.bias + sum(self.weights[f] for f in sorted(found))


def example(
    text: str, terms: tuple[str, ...] = IDENTITY_TERMS, neutral: tuple[str, ...] = NEUTRAL_TERMS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of a text, and those that it has only with an identity term and only with the one swapped for it.

    A term of the text is swapped; where it has none, one is put in first. The choice depends on the text alone.
    """
    words = words_of(text)
    draw = random.Random(zlib.crc32(text.encode()))
    there = sorted(words.intersection(terms))
    old = draw.choice(there) if there else draw.choice(terms)
    new = draw.choice([t for t in terms + neutral if t != old])
    rest = set().union(*(features(word) for word in words if word != old))
    with_old, with_new = features(old), features(new)
    parts = (rest | with_old if there else rest, with_old - rest, with_new - rest)
    return tuple(np.array(sorted(part), np.int32) for part in parts)


def _blocks(sets: list[np.ndarray], dense: np.ndarray) -> list[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows: which they are, the entries of each, and the places in ``dense`` of all entries that have one."""
    blocks, held, first = [], [], 0
    for end, places in enumerate((dense[s] for s in sets), 1):
        held.append(places[places >= 0])
        if end == len(sets) or sum(map(len, held)) >= BLOCK:
            blocks.append((slice(first, end), np.array([len(h) for h in held]), np.concatenate(held)))
            held, first = [], end
    return blocks


def _by_row(blocks: list[tuple[slice, np.ndarray, np.ndarray]], theta: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    for rows, sizes, col in blocks:
        out[rows] = np.bincount(np.repeat(np.arange(len(sizes)), sizes), theta[col], len(sizes))
    return out


def _by_entry(blocks: list[tuple[slice, np.ndarray, np.ndarray]], values: np.ndarray, n: int) -> np.ndarray:
    """The sum over the rows with each entry. A block adds to the sums so far, in the order of the rows: where blocks end
    changes nothing."""
    out, own = np.zeros(n), np.arange(n, dtype=np.int32)
    for rows, sizes, col in blocks:
        out = np.bincount(np.concatenate([own, col]), np.concatenate([out, np.repeat(values[rows], sizes)]), n)
    return out


def best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut that tells the two kinds of row apart best (rate of hits less rate of false alarms), mid-gap."""
    values = np.unique(logit)
    if len(values) < 2:
        return 0.0
    cuts = (values[1:] + values[:-1]) / 2
    of = lambda kind: 1 - np.searchsorted(np.sort(logit[y == kind]), cuts) / (y == kind).sum()
    gain = of(1) - of(0)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(cuts[best[np.diff(values)[best].argmax()]])


def train(
    examples: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: list[int], swap_penalty: float = 1.0,
    steps: int = 80, rate: float = 0.5,
) -> Model:
    """Proximal Adagrad over all given rows at once, for a fixed number of steps."""
    n, positive = len(labels), sum(labels)
    bias = float(np.log((positive + 0.5) / (n - positive + 1.5)))
    if not 0 < positive < n:
        return Model({}, bias)
    count = np.zeros(BUCKETS, np.int32)
    for every, _, _ in examples:
        count[every] += 1
    used = np.flatnonzero(count >= 2)
    dense = np.full(BUCKETS, -1, np.int32)
    dense[used] = np.arange(len(used))
    entries = _blocks([e[0] for e in examples], dense)
    swaps = [(_blocks([e[part] for e in examples], dense), sign) for part, sign in ((1, 1.0), (2, -1.0))]
    y = np.array(labels, np.float64)
    theta, square = np.zeros(len(used)), np.full(len(used), 1e-3)
    bias_square, lasso = 1e-3, 0.5 + n / 4000
    for _ in range(steps):
        logit = bias + _by_row(entries, theta, n)
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
        gradient = _by_entry(entries, error, len(used))
        change = sum(sign * _by_row(blocks, theta, n) for blocks, sign in swaps)
        for blocks, sign in swaps:
            gradient += 2 * swap_penalty * sign * _by_entry(blocks, change, len(used))
        square += gradient**2
        step = rate / np.sqrt(square)
        theta = theta - step * gradient
        theta = np.maximum(theta - step * lasso, 0)
        bias_square += error.sum() ** 2
        bias -= rate * error.sum() / np.sqrt(bias_square)
    bias -= best_cut(bias + _by_row(entries, theta, n), y)
    return Model({int(used[i]): float(theta[i]) for i in np.flatnonzero(theta)}, float(bias))


def fit(documents: DataFrame, labels: DataFrame, keep: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Train on at most ``rows`` labelled documents (a documented bound). Null texts count as empty; without two kinds of
    label the model answers with a smoothed share of label 1 that stays below a half where there is none.

    Features come to the driver as bytes, four each: a list of them would be Python numbers, of about forty."""
    small_batches(documents.sparkSession)
    chosen = sample(labels, label, keep, rows, key)
    joined = documents.join(chosen, F.col(key) == F.col("_key")).select("_key", "_label", F.col(text).alias("_text"))

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [example(t or "") for t in batch["_text"]]
            yield pd.DataFrame({
                "key": batch["_key"].astype("string"), "label": batch["_label"],
                **{name: [p[i].astype("<i4").tobytes() for p in parts] for i, name in enumerate(SETS)},
            })

    made = joined.mapInPandas(examples, "key string, label int, every binary, first binary, second binary").toPandas()
    made = made.sort_values(["key", "label"], kind="stable").reset_index(drop=True)
    sets = ([np.frombuffer(packed, "<i4") for packed in made[name]] for name in SETS)
    return train(list(zip(*sets)), made["label"].tolist())


def scored(df: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """df with the probability that each whole text is toxic in column ``into``; null texts count as empty."""
    small_batches(df.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            logits = np.array([model.logit(t or "") for t in batch], np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

    return df.withColumn(into, score(F.col(text)))
