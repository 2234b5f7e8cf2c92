"""Training-order materialisation of token ids.

The ids of all documents, in the order of the input's partitions, are cut into sequences of fixed length. A keyed Feistel
network on the smallest even number of bits that holds all sequence numbers, walked along its cycle until it lands
below their count, is a permutation: it gives each sequence its slot in the training order, and its inverse tells
which sequence stands in a slot. Shard k holds slots k * per_shard to (k + 1) * per_shard - 1, each a file of sequences
at a fixed stride, so that slot s is read from byte (s % per_shard) * stride of its file and reading resumes anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import once
from .shared import gathered, small_batches, stored
from .words import word_encoder

ROUNDS = 6


class Permutation:
    """A keyed bijection of 0 .. size - 1."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
        draw = np.random.default_rng(key)
        self.keys = draw.integers(0, 2**63, ROUNDS, dtype=np.uint64)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        """A hash of half a number, cut to half its bits."""
        x = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        low = np.uint64((1 << self.half) - 1)
        left, right = x >> np.uint64(self.half), x & low
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._mix(left, key), left
            else:
                left, right = right, left ^ self._mix(right, key)
        return (left << np.uint64(self.half)) | right

    def __call__(self, numbers: np.ndarray, back: bool = False) -> np.ndarray:
        out = self._once(np.asarray(numbers).astype(np.uint64), back)
        while (outside := np.flatnonzero(out >= self.size)).size:
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)


def filesystem_of(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def into_place(filesystem: pa.fs.FileSystem, made: str, name: str) -> None:
    """Rename a finished file. Not every file system renames onto a file that an earlier attempt has left."""
    if filesystem.get_file_info(name).type != pa.fs.FileType.NotFound:
        filesystem.delete_file(name)
    filesystem.move(made, name)


def read_slots(
    folder: str, total: int, start: int = 0, length: int = 4096, width: int = 1, per_shard: int = 4096
) -> Iterator[tuple[int, bytes]]:
    """(slot, its ids with their padding) for slots start .. total - 1, each shard opened once and read on from there.

    total is the number of rows of the manifest; reading resumes at the slot after the last one taken. A shard that is
    missing or too short fails.
    """
    (filesystem, base), stride = filesystem_of(folder), length * width
    while start < total:
        shard, at = divmod(start, per_shard)
        with filesystem.open_input_file(f"{base}/shard-{shard:08d}.bin") as file:
            file.seek(at * stride)
            for slot in range(start, min((shard + 1) * per_shard, total)):
                data = file.read(stride)
                if len(data) != stride:
                    raise RuntimeError(f"slot {slot} is not in its shard")
                yield slot, data
        start = (shard + 1) * per_shard


MANIFEST = T.StructType([
    T.StructField("slot", T.LongType()), T.StructField("sequence", T.LongType()), T.StructField("shard", T.LongType()),
    T.StructField("position", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


def token_ids(df: DataFrame, tokenizer: str, end_id: int = 0xFFFF, text: str = "text") -> DataFrame:
    """ids: the ids of each text by the tokenizer file and ``end_id``, two little-endian bytes each (null text: empty)."""
    small_batches(df.sparkSession)
    last = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("words", tokenizer), lambda: word_encoder(tokenizer))
        for batch in gathered(batches, 0):
            rows = []
            for wide in encoder.encode([t or "" for t in batch.column(0).to_pylist()]):
                if wide.size and wide.max() >= 0xFFFF:
                    raise ValueError(f"id {wide.max()} does not fit two bytes")
                rows.append(wide.astype("<u2").tobytes() + last)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    return df.select(text).mapInArrow(run, "ids binary")


def materialise(
    df: DataFrame, folder: str, length: int = 4096, width: int = 1, per_shard: int = 4096, key: int = 20_26, pad: int = 255,
    ids: str = "ids",
) -> DataFrame:
    """Write the shards to ``folder`` (any place that executors share) and return the stored manifest: slot, sequence,
    shard, position (byte in the shard's file), n_ids (without padding), ids_crc32 (of these).

    ids: binary column of little-endian ids of ``width`` bytes. A null or empty one adds nothing. Only the last sequence of
    each input partition is padded, with the byte ``pad``. Repeated rows are written as often as they occur; other
    columns are not read. An empty df writes nothing. The input's partitions must come out the same each time, as those
    of a table scan do; a task that finds another number of ids than was counted fails. A task writes its file under
    another name first and then moves it into place, over the same file of an earlier attempt if there is one, so losing
    executors leaves no half-written shard.
    """
    spark, stride = df.sparkSession, length * width
    small_batches(spark)
    data = df.select(F.col(ids).cast("binary").alias("ids"))
    counts = {
        r[0]: r[1] for r in
        data.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.octet_length("ids")).alias("bytes")).collect() if r[1]
    }  # one row for each partition
    first, total = {}, 0
    for part in sorted(counts):
        first[part] = total
        total += -(-counts[part] // stride)
    order = Permutation(total, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, rest = TaskContext.get().partitionId(), 0, b""
        number = first.get(part, 0)

        def made(run: bytes) -> pa.RecordBatch:
            nonlocal number
            pieces = [run[at : at + stride] for at in range(0, len(run), stride)]
            numbers = np.arange(number, number + len(pieces))
            number += len(pieces)
            slots = order(numbers)
            sizes = pa.array(map(len, pieces), pa.int64())
            packed = [pa.compress(piece, codec="zstd", asbytes=True) for piece in pieces]  # for the shuffle
            return pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(numbers), sizes, pa.array(packed, pa.binary())], ["slot", "sequence", "size", "ids"]
            )

        for batch in batches:
            run = rest + b"".join(x for x in batch.column(0).to_pylist() if x)
            seen += len(run) - len(rest)
            whole = len(run) - len(run) % stride
            rest = run[whole:]
            if whole:
                yield made(run[:whole])
        if seen != counts.get(part, 0):
            raise RuntimeError("the input's partitions changed between counting and cutting")
        if rest:
            yield made(rest)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = filesystem_of(folder)
        filesystem.create_dir(base, recursive=True)
        shard, out, at = None, None, 0
        attempt = TaskContext.get().taskAttemptId()

        def close() -> None:
            if out is not None:
                out.close()
                into_place(filesystem, name(shard) + f".{attempt}", name(shard))

        def name(number: int) -> str:
            return f"{base}/shard-{number:08d}.bin"

        for batch in batches:
            rows = []
            for slot, sequence, size, packed in zip(batch["slot"], batch["sequence"], batch["size"], batch["ids"]):
                payload = pa.decompress(packed, size, codec="zstd", asbytes=True)
                if slot // per_shard != shard:
                    close()
                    shard, at = slot // per_shard, 0
                    out = filesystem.open_output_stream(name(shard) + f".{attempt}")
                if slot % per_shard != at:
                    raise RuntimeError(f"slot {slot} is not the next one of its shard")
                out.write(payload.ljust(stride, bytes([pad])))
                rows.append((slot, sequence, shard, at * stride, len(payload) // width, zlib.crc32(payload)))
                at += 1
            yield pd.DataFrame(rows, columns=MANIFEST.names).astype("int64")
        close()

    sequences = data.mapInArrow(cut, "slot long, sequence long, size long, ids binary")
    shards = -(-total // per_shard)
    if not shards:
        return spark.createDataFrame([], MANIFEST)
    by_slot = sequences.repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int"))
    return stored(by_slot.sortWithinPartitions("slot").mapInPandas(write, MANIFEST), "manifest")
