"""Packing by sum of squares.

Documents arrive one by one. Full windows of a long document are closed at once; its rest goes to the fill level where
placing it leaves the smallest sum of squared counts of partially filled windows, the counts standing in an array with
one entry for each level. Where the open windows become too many, and at the end of a partition, they are poured
together: the emptiest are cut into the free space of the fullest, so that at most one window per partition stays partly
filled. Every Spark partition packs its own documents: no shuffle, and state bounded by ``MOST_OPEN`` windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import once
from .shared import gathered, small_batches
from .words import word_encoder

MOST_OPEN = 4096
NEVER = np.iinfo(np.int64).max

PIECES = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])


class SumOfSquares:
    """Packs pieces (document, start, ids, size of the document) into windows of ``length`` ids."""

    def __init__(self, length: int, most_open: int = MOST_OPEN):
        self.length, self.most_open, self.open = length, most_open, 0
        self.count = np.zeros(length + 1, np.int64)  # open windows at each fill level
        self.at: list[list[list]] = [[] for _ in range(length)]
        self.closed: list[list] = []

    def add(self, doc, ids: bytes) -> None:
        size = len(ids) // 4
        whole = size - size % self.length
        for start in range(0, whole, self.length):
            self.closed.append([(doc, start, ids[4 * start : 4 * (start + self.length)], size)])
        if size > whole:
            self._place((doc, whole, ids[4 * whole :], size), size - whole)

    def _place(self, piece: tuple, size: int) -> None:
        level = self.best_level(size)
        window = []
        if level:
            window = self.at[level].pop()
            self.count[level] -= 1
            self.open -= 1
        window.append(piece)
        if level + size == self.length:
            self.closed.append(window)
            return
        self.at[level + size].append(window)
        self.count[level + size] += 1
        self.open += 1
        if self.open > self.most_open:
            self.pour()

    def best_level(self, size: int) -> int:
        """The level whose use changes the sum of squares least (0: a new window); of equals the fullest."""
        top = self.length - size
        here, there = self.count[: top + 1], self.count[size:].copy()
        there[top] = 0  # a full window no longer counts
        change = 2 * (there - here) + 2
        change[top] -= 1
        change[here == 0] = NEVER
        change[0] = 2 * self.count[size] + 1
        return top - int(change[::-1].argmin())

    def pour(self) -> None:
        """Close all open windows, as few as they fill: the emptiest are cut into the free space of the fullest."""
        windows = [window for level in range(self.length - 1, 0, -1) for window in self.at[level]]
        fills = [sum(len(piece[2]) // 4 for piece in window) for window in windows]
        kept = -(-sum(fills) // self.length)
        pieces = [piece for window in windows[kept:] for piece in window]
        for window, fill in zip(windows[:kept], fills):
            while fill < self.length and pieces:
                doc, start, ids, size = pieces.pop()
                room = self.length - fill
                if len(ids) // 4 > room:
                    pieces.append((doc, start + room, ids[4 * room :], size))
                    ids = ids[: 4 * room]
                window.append((doc, start, ids, size))
                fill += len(ids) // 4
        self.closed += windows[:kept]
        self.count[:], self.at, self.open = 0, [[] for _ in range(self.length)], 0


def pack(
    df: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids if kept).

    A document is its ids by the tokenizer file (null text: empty) and ``end_id``; it is cut only at the window length and
    where windows are poured together. Sequence ids are partition number * 2^32 + number in the partition. Keys are
    carried as they are, null or repeated: every row is a document of its own. Other columns are dropped, whatever
    their names; an empty df gives no rows.
    """
    small_batches(df.sparkSession)
    key = df.schema[doc_id]
    fields = [T.StructField(key.name, key.dataType), *PIECES.fields]
    schema = T.StructType(fields + ([T.StructField("ids", T.BinaryType())] if keep_ids else []))
    last = np.array([end_id], "<i4").tobytes()

    def rows(windows: list[list], first: int, keys_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        if not windows:
            return
        columns: list[list] = [[] for _ in schema.fields]
        for number, window in enumerate(windows):
            offset = 0
            for doc, start, ids, size in window:
                n = len(ids) // 4
                values = (doc, start, n, zlib.crc32(ids), size, first + number, offset)
                for column, value in zip(columns, values + (ids,)):
                    column.append(value)
                offset += n
        kinds = [keys_type] + [pa.int64()] * 6 + [pa.binary()] * keep_ids
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("words", tokenizer), lambda: word_encoder(tokenizer))
        packer, made, keys_type = SumOfSquares(length), TaskContext.get().partitionId() << 32, None
        for batch in gathered(batches, 1):
            keys_type = batch.schema.field(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                packer.add(doc, ids.tobytes() + last)
            yield from rows(packer.closed, made, keys_type)
            made += len(packer.closed)
            packer.closed = []
        packer.pour()
        yield from rows(packer.closed, made, keys_type)

    return df.select(doc_id, text).mapInArrow(run, schema)
