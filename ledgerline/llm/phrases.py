"""Distributed positional inverted index, and exact phrase and proximity search in it.

Documents are gathered into blocks of a bounded number of characters (a longer one is a block of its own). The index stores one
row for each block: its terms and, term after term, the ascending positions at which each stands, the words of all its
documents being numbered through. Blocks are independent, so an index of any size is built and searched without a
shuffle, and a term that is very frequent is never gathered in one place.

A search is given its windows of words in parts of bounded bytes. In every block each window starts from the postings of
its rarest term there, shifted by the term's offset in the window: those are the possible starts. The shifted postings of
its other terms, rarest first, are intersected with them, and what is left is an occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Numbered, free_name, new_folder, small_batches, stored

WINDOW = 10
BLOCK_CHARACTERS = 2 << 20
PART_BYTES = 4 << 20
#: Possible starts handled together: bounds the memory of a search.
STARTS_AT_ONCE = 1 << 20
#: Fixed: ASCII digits and letters after lower-casing A-Z, and every character beyond ASCII, that is all bytes of it.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

SPAN = T.StructType([T.StructField("first", T.LongType(), False), T.StructField("last", T.LongType(), False)])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN, False)),
    T.StructField("items", T.ArrayType(T.StringType(), False)),
])


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower changes A-Z only."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def index(df: DataFrame, key: str = "doc_id", text: str = "text", block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """The stored index of all texts, one row for each block: block, keys, sizes (words of each document), terms (joined by
    spaces), counts (of each term), positions (uint32, term after term).

    Keys are carried as they are, null or repeated: every row is a document. A null, empty or wordless text has no
    postings and keeps its place. Other columns are not read; an empty df gives an empty index.
    """
    small_batches(df.sparkSession)
    kind = df.schema[key].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
        T.StructField("counts", T.BinaryType()), T.StructField("positions", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, sizes, held, terms, codes, kind = TaskContext.get().partitionId() << 32, [], [], 0, Numbered(), [], None

        def made() -> pa.RecordBatch:
            code = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            columns = [
                pa.array([block]), pa.array([keys], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())),
                b" ".join(terms), np.bincount(code, minlength=len(terms)).astype("<u4").tobytes(),
                np.argsort(code, kind="stable").astype("<u4").tobytes(),
            ]
            return pa.RecordBatch.from_arrays(columns[:3] + [pa.array([c], pa.binary()) for c in columns[3:]], schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if keys and held + len(text or "") > block_characters:
                    yield made()
                    block, keys, sizes, held, terms, codes = block + 1, [], [], 0, Numbered(), []
                codes.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                keys.append(doc)
                sizes.append(len(words))
                held += len(text or "")
        if keys:
            yield made()

    return stored(df.select(key, text).mapInArrow(run, schema), "index")


class Windows:
    """The distinct windows of the words of some items: ``length`` words in a row, or all of a shorter item."""

    def __init__(self, items: list[tuple[str | None, str | None]], length: int):
        self.vocabulary, found = Numbered(), {}
        for name, text in items:
            words = [self.vocabulary[word] for word in words_of(text)]
            for at in range(max(1, len(words) - length + 1) if words else 0):
                found.setdefault(tuple(words[at : at + length]), set()).add(name)
        self.by_length: dict[int, tuple[np.ndarray, list[set]]] = {}
        for size in sorted({len(window) for window in found}):
            same = [(window, names) for window, names in found.items() if len(window) == size]
            self.by_length[size] = np.array([w for w, _ in same], np.int64).reshape(-1, size), [n for _, n in same]


class Block:
    """The postings of one block, ready to be intersected."""

    def __init__(self, sizes: list[int], terms: bytes, counts: bytes, positions: bytes):
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.terms = {word: i for i, word in enumerate(terms.split(b" "))} if terms else {}
        self.counts = np.append(np.frombuffer(counts, "<u4").astype(np.int64), 0)  # last: a term that is not there
        self.starts = np.cumsum(self.counts) - self.counts
        self.positions = np.frombuffer(positions, "<u4").astype(np.int64)
        self.sorted = np.repeat(np.arange(len(self.counts)) << 32, self.counts) | self.positions  # (term, position)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, "right")

    def search(
        self, windows: np.ndarray, vocabulary: list[bytes], reach: int | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a window, position) in groups. Without ``reach`` the positions at which a window's words start and
        follow each other in one document; with it those of its rarest term for which every other term stands in the same
        document at most so many words away."""
        if not len(windows):
            return
        local = np.array([self.terms.get(word, -1) for word in vocabulary], np.int64)[windows]
        possible = np.flatnonzero((local >= 0).all(axis=1))
        local = local[possible]
        rarest_first = np.argsort(self.counts[local], axis=1, kind="stable")
        local = np.take_along_axis(local, rarest_first, axis=1)
        n = self.counts[local[:, 0]] if len(local) else np.zeros(0, np.int64)
        groups = np.cumsum(n) // STARTS_AT_ONCE  # a single list is held whole: it is no longer than the block
        for group in np.unique(groups):
            rows = np.flatnonzero(groups == group)
            window = np.repeat(rows, n[rows])
            inside = np.arange(len(window)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
            at = self.positions[self.starts[local[window, 0]] + inside]
            if reach is None:
                at = at - rarest_first[window, 0]
            for k in range(1, local.shape[1]):
                term = local[window, k] << 32
                if reach is None:
                    keep = self._first(term | (at + rarest_first[window, k])) == (term | (at + rarest_first[window, k]))
                    keep &= at >= 0
                else:
                    doc = self.document(at)
                    low = np.maximum(at - reach, np.append(0, self.ends)[doc])
                    keep = self._first(term | low) <= (term | np.minimum(at + reach, self.ends[doc] - 1))
                window, at = window[keep], at[keep]
            if reach is None and len(at):
                whole = (at >= 0) & (self.document(at) == self.document(at + local.shape[1] - 1))
                window, at = window[whole], at[whole]
            if len(at):
                yield possible[window], at

    def _first(self, key: np.ndarray) -> np.ndarray:
        """The smallest (term, position) that is not below each key."""
        place = np.searchsorted(self.sorted, key)
        return np.append(self.sorted, np.iinfo(np.int64).max)[place]


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Runs of covered words."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    cut = np.flatnonzero(first[1:] > last[:-1] + 1)
    return list(zip(first[np.append(0, cut + 1)].tolist(), last[np.append(cut, len(last) - 1)].tolist()))


def _search_part(built: DataFrame, items: list[tuple], key: str, length: int, reach: int | None) -> DataFrame:
    """One row for each document of the index: block, number in it, key and FOUND for these items."""
    kind = built.schema["keys"].dataType.elementType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("number", T.LongType()), T.StructField(key, kind), *FOUND.fields
    ])
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = Windows(items, length)
        vocabulary = list(searched.vocabulary)
        for batch in batches:
            keys_kind = batch.schema.field("keys").type.value_type
            for row in batch.to_pylist():
                block = Block(row["sizes"], row["terms"], row["counts"], row["positions"])
                begins = block.ends - np.array(row["sizes"], np.int64)
                spans: dict[int, list] = {}
                items_of: dict[int, set] = {}
                for size, (windows, names) in searched.by_length.items():
                    for window, at in block.search(windows, vocabulary, reach):
                        doc = block.document(at)
                        order = np.argsort(doc, kind="stable")
                        doc, window, at = doc[order], window[order], at[order]
                        for rows in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1):
                            d = int(doc[rows[0]])
                            first = at[rows] - begins[d]
                            spans.setdefault(d, []).append((first, first + (size - 1 if reach is None else 0)))
                            items_of.setdefault(d, set()).update(*[names[w] for w in np.unique(window[rows]).tolist()])
                n = len(row["keys"])
                covered = [
                    [{"first": a, "last": b} for a, b in _merged(*map(np.concatenate, zip(*spans[d])))] if d in spans else []
                    for d in range(n)
                ]
                named = [sorted(items_of.get(d, set()) - {None}) for d in range(n)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["block"]] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array(row["keys"], keys_kind), pa.array(row["sizes"], pa.int64()),
                    pa.array(covered, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                    pa.array(named, pa.list_(pa.string())),
                ], schema.names)

    return built.mapInArrow(run, schema)


def search(
    built: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", key: str = "doc_id",
    length: int = WINDOW, reach: int | None = None, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row for each document of a stored index: key, n_words, spans and items.

    A window is ``length`` consecutive words of an item, or the whole of a shorter one; an item without words has none.
    spans are the runs of words (numbered from 0) inside any occurrence of a window, items the sorted ids (as text) of
    the items with occurring windows. With ``reach`` the search is for proximity: a window is found where every one of its
    terms stands at most so many words from its rarest one, and spans are the places of the latter.

    Items are sent to the executors in parts of about ``part_bytes`` of text, one after the other, whose results are
    merged, so that a table of items of any size is searched. Repeated items count once; an item without an id marks
    words and is not listed. Other columns are not read; an empty table of items finds nothing.
    """
    name = free_name(items, "part")
    asked = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))
    if parts == 1:
        return _search_part(built, [tuple(r) for r in asked.collect()], key, length, reach).select(key, *FOUND.names)
    asked = stored(asked.withColumn(name, F.pmod(F.xxhash64("id", "text"), F.lit(parts))), "items")
    folder = new_folder(built.sparkSession, "found")
    for part in range(parts):
        chosen = [tuple(r) for r in asked.filter(F.col(name) == part).select("id", "text").collect()]
        found = _search_part(built, chosen, key, length, reach)
        found.write.parquet(f"{folder}/part={part}")
    found = built.sparkSession.read.schema(found.schema).parquet(*[f"{folder}/part={part}" for part in range(parts)])
    together = found.groupBy("block", "number").agg(
        F.first(key).alias(key), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
    )
    return together.select(key, "n_words", united("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def united(spans: str) -> Column:
    """Runs of words that overlap or touch made one."""
    nothing = F.array().cast(T.ArrayType(SPAN, False))

    def add(runs: Column, span: Column) -> Column:
        before = F.try_element_at(runs, F.lit(-1))
        longer = F.struct(before["first"].alias("first"), F.greatest(before["last"], span["last"]).alias("last"))
        touching = F.coalesce(span["first"] <= before["last"] + 1, F.lit(False))
        shorter = F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when(touching, F.concat(shorter, F.array(longer))).otherwise(F.concat(runs, F.array(span)))

    return F.aggregate(F.array_sort(spans), nothing, add).alias(spans)
