"""Byte-level BPE encoding and decoding in length-bucketed numpy matrices.

Texts are cut into the matches of the tokenizer's pattern. The distinct matches of a batch are sorted into buckets of
similar byte length and stand as rows of a padded matrix of symbols. In every round each row merges its leftmost pair
of smallest rank, found through a hash table of all mergeable pairs, closes the gap and shrinks by one column; rows
without a mergeable pair leave the matrix. Matches of more than ``WIDEST`` bytes, for which a round per merge would
cost quadratic time, are merged with a heap instead, by the same rule.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import Memory, small_batches

NEVER = np.iinfo(np.int64).max
ID_BITS = 20
WIDEST = 192
#: Symbols in one matrix and chunks handled together: bounds of a Python worker's memory.
MATRIX_CELLS = 1 << 20
CHUNKS_AT_ONCE = 120_000
#: Fixed: Unicode's White_Space, which the tokenizer's pattern means by \s.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Cuts a text only where the tokenizer's pattern always cuts it, too.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class PairTable:
    """Hash table from a pair of symbols to (rank, merged symbol), packed into one number that sorts by rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.bits = max(10, int(len(left) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NEVER, np.int64)
        key = (left.astype(np.int64) << ID_BITS) | right
        value = (rank.astype(np.int64) << ID_BITS) | merged
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            wins = np.zeros(len(slot), bool)
            wins[first] = True
            wins &= free
            self.keys[slot[wins]], self.values[slot[wins]] = key[wins], value[wins]
            key, value = key[~wins], value[~wins]
            slot = (slot[~wins] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The packed value of each pair; NEVER for a pair that does not merge or holds padding."""
        key = (left.astype(np.int64) << ID_BITS) | right
        out = np.full(len(key), NEVER, np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(key[open_])
        while len(open_):
            there = self.keys[slot]
            hit = there == key[open_]
            out[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (there >= 0)
            open_, slot = open_[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out


class Bpe:
    """Merges symbol sequences. start: symbol of each byte; start_last: the same for a sequence's last byte."""

    def __init__(self, start: np.ndarray, start_last: np.ndarray, pairs: PairTable):
        self.start, self.start_last, self.pairs = start.astype(np.int32), start_last.astype(np.int32), pairs

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The symbols of each word as packed little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]
        at = 0
        while at < len(order):
            width = int(sizes[order[at]])
            if width > WIDEST:
                for i in order[at:]:
                    out[i] = self._heap(words[i])
                break
            widest = width if width <= 16 else min(WIDEST, width + width // 4)
            end = int(np.searchsorted(sizes[order], widest, "right"))
            end = min(end, at + max(1, MATRIX_CELLS // widest))
            rows = order[at:end]
            self._matrix([words[i] for i in rows], sizes[rows], rows, out)
            at = end
        return out

    def _matrix(self, words: list[bytes], sizes: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
        width = int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        symbols = np.full((len(words), width), -1, np.int32)
        symbols[inside] = self.start[np.frombuffer(b"".join(words), np.uint8)]
        last = np.fromiter((w[-1] for w in words), np.uint8, len(words))
        symbols[np.arange(len(words)), sizes - 1] = self.start_last[last]
        values = self.pairs.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(words), width - 1)
        while len(rows):
            if values.shape[1] == 0:
                self._leave(symbols, rows, out)
                return
            here = values.argmin(axis=1)
            line = np.arange(len(rows))
            best = values[line, here]
            done = best == NEVER
            if done.any():
                self._leave(symbols[done], rows[done], out)
                go = ~done
                symbols, values, rows, here, best = symbols[go], values[go], rows[go], here[go], best[go]
                line = np.arange(len(rows))
                if not len(rows):
                    return
            symbols[line, here] = best & ((1 << ID_BITS) - 1)
            width = symbols.shape[1] - 1
            columns = np.arange(width)
            symbols = np.take_along_axis(symbols, columns + (columns > here[:, None]), axis=1)
            columns = columns[: width - 1]
            values = np.take_along_axis(values, columns + (columns >= here[:, None]), axis=1)
            left = np.flatnonzero(here > 0)
            values[left, here[left] - 1] = self.pairs.find(symbols[left, here[left] - 1], symbols[left, here[left]])
            right = np.flatnonzero(here < width - 1)
            values[right, here[right]] = self.pairs.find(symbols[right, here[right]], symbols[right, here[right] + 1])

    @staticmethod
    def _leave(symbols: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
        sizes = (symbols >= 0).sum(axis=1)
        packed = symbols[symbols >= 0].astype("<i4").tobytes()
        at = 0
        for row, size in zip(rows.tolist(), (4 * sizes).tolist()):
            out[row] = packed[at : at + size]
            at += size

    def _heap(self, word: bytes) -> bytes:
        """The same merges, in order of (rank, place), over a linked list."""
        symbols = self.start[np.frombuffer(word, np.uint8)]
        symbols[-1] = self.start_last[word[-1]]
        found = self.pairs.find(symbols[:-1], symbols[1:])
        heap = [(value, i) for i, value in enumerate(found.tolist()) if value != NEVER]
        heapq.heapify(heap)
        symbol, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        value_at = found.tolist() + [NEVER]

        def renew(i: int) -> None:
            j = after[i]
            value = NEVER if j >= n else int(self.pairs.find(np.array([symbol[i]]), np.array([symbol[j]]))[0])
            value_at[i] = value
            if value != NEVER:
                heapq.heappush(heap, (value, i))

        while heap:
            value, i = heapq.heappop(heap)
            if value_at[i] != value or symbol[i] < 0:
                continue
            j = after[i]
            symbol[i], symbol[j], value_at[j] = value & ((1 << ID_BITS) - 1), -1, NEVER
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([s for s in symbol if s >= 0], "<i4").tobytes()


class Encoder:
    """Texts to packed ids. Remembers chunks between texts; ``new`` gives the ids of chunks not seen before.

    chunks: pattern of a chunk; split: a quicker way to all chunks of a text, which may also give empty ones.
    """

    def __init__(
        self, chunks: re.Pattern, new: Callable[[list[str]], list[bytes]],
        split: Callable[[str], list[str]] | None = None, known: Memory | None = None,
    ):
        self.chunks, self.new, self.known = chunks, new, Memory() if known is None else known
        self.split = split or chunks.findall

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. Texts go through in groups of bounded size, a very long text in several parts."""
        out, group, held = [], [], 0
        for text in texts:
            if len(text) > 4 * CHUNKS_AT_ONCE:
                out += self._group(group)
                parts = (m.group() for m in self.chunks.finditer(text))
                joined = []
                while part := list(islice(parts, CHUNKS_AT_ONCE)):
                    joined += self._group([part])
                out.append(b"".join(joined))
                group, held = [], 0
                continue
            group.append(self.split(text))
            held += len(group[-1])
            if held > CHUNKS_AT_ONCE:
                out += self._group(group)
                group, held = [], 0
        return out + self._group(group)

    def _group(self, group: list[list[str]]) -> list[bytes]:
        distinct = set().union(*group) if group else set()
        self.known.make_room()
        unseen = [chunk for chunk in distinct if chunk not in self.known]
        self.known.keep(zip(unseen, self.new(unseen)))
        get = self.known.__getitem__
        return [b"".join(map(get, chunks)) for chunks in group]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by id."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in rows))
    for token, rank in rows:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def rank_bpe(tokens: list[bytes]) -> Bpe:
    """Two tokens merge when their bytes together are a token; its id is the rank."""
    ids = {token: i for i, token in enumerate(tokens) if token}
    rows = [
        (ids[token[:cut]], ids[token[cut:]], i)
        for token, i in ids.items() for cut in range(1, len(token))
        if token[:cut] in ids and token[cut:] in ids
    ]
    left, right, merged = np.array(rows, np.int64).reshape(-1, 3).T
    start = np.array([ids.get(bytes([b]), 0) for b in range(256)])
    return Bpe(start, start, PairTable(left, right, merged, merged))


def rank_encoder(tokens: list[bytes], pattern: str) -> Encoder:
    ids = {token: np.array([i], "<i4").tobytes() for i, token in enumerate(tokens) if token}
    bpe, split = rank_bpe(tokens), regex.compile(pattern)

    def new(chunks: list[str]) -> list[bytes]:
        rows = list(map(split.findall, chunks))
        pieces = list(set(chain.from_iterable(rows)))
        words = [piece.encode() for piece in pieces]
        packed = list(map(ids.get, words))
        open_ = [i for i, found in enumerate(packed) if found is None]
        for i, found in zip(open_, bpe.encode([words[i] for i in open_])):
            packed[i] = found
        known = dict(zip(pieces, packed))
        return [known[row[0]] if len(row) == 1 else b"".join([known[piece] for piece in row]) for row in rows]

    return Encoder(CHUNK, new)


_made: dict = {}


def once(key: tuple, make: Callable):
    """make(), made once in each Python worker."""
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _with_column(schema: T.StructType, without: str, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in (without, name)] + [T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, schema: T.StructType, column: pa.Array) -> pa.RecordBatch:
    names = schema.names
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names[:-1]] + [column], names)


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """df with the array of token ids of each whole text in place of the text (and of a column ``into``, if any).

    A null or empty text has no ids. ranks: path of a rank file that every executor has. No row is dropped or merged;
    all other columns stay.
    """
    small_batches(df.sparkSession)
    schema = _with_column(df.schema, text, into, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("encoder", ranks, pattern), lambda: rank_encoder(read_ranks(ranks), pattern))
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            packed = encoder.encode(texts)
            ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            yield _replaced(batch, schema, pa.ListArray.from_arrays(pa.array(ends), ids))

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids: str = "ids", into: str = "bytes") -> DataFrame:
    """df with the bytes that each array of ids stands for in place of the ids. Null or empty ids give no bytes."""
    schema = _with_column(df.schema, ids, into, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = once(("tokens", ranks), lambda: read_ranks(ranks))
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        letters = np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            counts = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            decoded = []
            for rows in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(np.cumsum(counts) >> 20)) + 1):
                if len(rows):
                    first = int(counts[: rows[0]].sum())
                    own = flat[first : first + int(counts[rows].sum())]
                    long = size[own]
                    ends = np.cumsum(long)
                    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[own] - (ends - long), long)
                    text = letters[place].tobytes()
                    cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts[rows])])].tolist()
                    decoded += [text[a:b] for a, b in zip(cuts, cuts[1:])]
            yield _replaced(batch, schema, pa.array(decoded, pa.binary()))

    return df.mapInArrow(run, schema)
