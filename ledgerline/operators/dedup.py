"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, key: str, newest_first: Sequence[str] = ()) -> list[Column]:
    """The given columns newest first, then every other column, so that equal timestamps never leave a choice open."""
    rest = [name for name in df.columns if name != key and name not in newest_first]
    return [F.desc_nulls_last(name) for name in newest_first] + [F.asc_nulls_last(name) for name in rest]


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group.

    Spark limits each group to one row inside every input partition before the shuffle (WindowGroupLimit), so a key that
    holds a large part of all rows sends one row per task, not its whole group.
    """
    position = "__position"
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) == 1).drop(position)


def newest_per_key(
    raw: DataFrame,
    key: str,
    standardise: Callable[[DataFrame], DataFrame],
    newest_first: Sequence[str] = (),
    keep_keyless: bool = True,
) -> DataFrame:
    """Standardise the rows, then keep the newest row of each key, in one pass over them.

    Keys are compared after standardising, so " C1" and "C1" are one key, and a blank key is none. Rows without a key cannot
    be compared: all of them are kept for quarantine, each in a group of its own that any task may hold, or left out
    where only good rows are wanted.
    """
    rows = standardise(raw)
    order = total_order(rows, key, newest_first)
    if not keep_keyless:
        return top_per_group(rows.where(F.col(key).isNotNull()), [key], order)
    alone = "__alone"
    numbered = rows.withColumn(alone, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    return top_per_group(numbered, [key, alone], order).drop(alone)
