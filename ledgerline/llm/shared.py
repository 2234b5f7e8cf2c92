"""Helpers that the operators have in common: intermediate tables and safe column names."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or one in the warehouse where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write df once (with Parquet ``options``) and read it back: later steps neither repeat its work nor depend on lost
    executors.

    The folder belongs to the caller's run; results that are still unread may need it, so it is not removed here.
    """
    path = new_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512, size: str = "16m") -> None:
    """Have whole texts sent to Python workers in batches of few rows and bytes: a batch is held in memory, texts can be long.

    Spark reads these limits when a plan runs, not when it is made, so they stay set in the caller's session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, with underscores added until no column of df has that name (whatever its case)."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def gathered(batches: Iterator[pa.RecordBatch], text: int, size_wanted: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """The batches joined until their texts (column number ``text``) hold about so many bytes: work on distinct words pays
    for larger groups."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= size_wanted:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if any(batch.num_rows for batch in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Memory(dict):
    """What a Python worker remembers of the words it has seen, in about so many bytes and those of the last group."""

    def __init__(self, most_bytes: int = 128 << 20):
        super().__init__()
        self.most_bytes, self.held = most_bytes, 0

    def make_room(self) -> bool:
        """Called before a group: forget all where the bound is reached."""
        if self.held <= self.most_bytes:
            return False
        self.clear()
        self.held = 0
        return True

    def keep(self, entries: Iterable[tuple]) -> None:
        for key, value in entries:
            self[key] = value
            self.held += sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES


#: An entry of a dictionary, beside its key and value.
ENTRY_BYTES = 100


class Numbered(dict):
    """Numbers its keys in the order in which they are asked for first."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number
