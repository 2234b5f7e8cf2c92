"""Referential checks: does the row a column points to exist?

Two plans give the same answer.

* ``flag_by_lookup`` left-joins the rows to the known keys. No hint is given: Spark broadcasts a key set whose size is
  below its threshold and shuffles otherwise, with AQE splitting the partition of a hot key. Right when the key sets are
  small.
* ``missing_keys`` + ``flag_by_exception`` first turn the rows into (reference, key) pairs, all references in one pass.
  The pairs are made distinct before and after one shuffle (a key holding a third of all rows is sent once per task),
  those that are known are taken out by one join with the known pairs, and the rows are marked by what is left. The wide
  rows never move for a large key set. Right when rows and key sets are both large and most references hold. The caller
  may store the missing pairs in between, so that the joins see their real size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Reference(NamedTuple):
    """``column`` must occur in ``keys`` (one column, no duplicates); the answer goes to the boolean ``flag``."""

    column: str
    keys: DataFrame
    flag: str


def _single_column(keys: DataFrame, name: str) -> DataFrame:
    return keys.select(F.col(keys.columns[0]).alias(name))


def flag_by_lookup(df: DataFrame, references: Sequence[Reference]) -> DataFrame:
    for ref in references:
        found = f"__{ref.flag}"
        known = _single_column(ref.keys, found)
        df = df.join(known, F.col(ref.column) == F.col(found), "left")
        df = df.withColumn(ref.flag, F.col(found).isNotNull()).drop(found)
    return df


def missing_keys(df: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """(reference_column, missing_key) for every referenced key that does not exist, from one pass over the rows.

    The known keys are never broadcast: how large they are is not known from the size of the files they are read from.
    """
    pointers = [F.struct(F.lit(ref.column).alias("reference_column"), F.col(ref.column).alias("missing_key")) for ref in references]
    used = df.select(F.inline(F.array(*pointers))).where(F.col("missing_key").isNotNull()).distinct()
    known = reduce(DataFrame.unionByName, [
        _single_column(ref.keys, "missing_key").select(F.lit(ref.column).alias("reference_column"), "missing_key")
        for ref in references
    ])
    return used.join(known.hint("merge"), ["reference_column", "missing_key"], "left_anti")


def missing_of(missing: DataFrame, column: str) -> DataFrame:
    """The missing keys of one reference."""
    return missing.where(F.col("reference_column") == column).select("missing_key")


def flag_by_exception(
    df: DataFrame, references: Sequence[Reference], missing: DataFrame | Mapping[str, DataFrame]
) -> DataFrame:
    """``missing`` holds the missing keys of all references, or the keys of each one under its column."""
    for ref in references:
        absent_key = f"__{ref.flag}"
        keys = missing_of(missing, ref.column) if isinstance(missing, DataFrame) else missing[ref.column]
        absent = keys.select(F.col("missing_key").alias(absent_key))
        df = df.join(absent, F.col(ref.column) == F.col(absent_key), "left")
        df = df.withColumn(ref.flag, F.col(ref.column).isNotNull() & F.col(absent_key).isNull()).drop(absent_key)
    return df
