"""Slowly changing dimensions: tracked changes open a new version, corrections overwrite the current one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALIDITY = ("valid_from", "valid_till", "is_current")

NEW, TYPE_2, TYPE_1, STALE, UNCHANGED = "new", "type2", "type1", "stale", "unchanged"


class History(NamedTuple):
    key: str
    versioned_by: str               # timestamp of a change
    tracked: Sequence[str]          # a difference opens a new version
    overwritten: Sequence[str]      # a difference only corrects the current version


def _differs(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(f"new.{n}").eqNullSafe(F.col(f"old.{n}")) for n in names])


def _change_type(spec: History) -> Column:
    """Kind of change of an incoming row against the current version; NULL when no row came in.

    A row that is not newer than the current version is stale: applying it would close a version before it began.
    """
    tracked, corrected = _differs(spec.tracked), _differs(spec.overwritten)
    new_time, old_time = F.col(f"new.{spec.versioned_by}"), F.col(f"old.{spec.versioned_by}")
    late = F.coalesce(new_time <= old_time, new_time.isNull())
    return (
        F.when(F.col(f"new.{spec.key}").isNull(), F.lit(None).cast("string"))
        .when(F.col(f"old.{spec.key}").isNull(), NEW)
        .when(~tracked & ~corrected, UNCHANGED)
        .when(late, STALE)
        .when(tracked, TYPE_2)
        .otherwise(TYPE_1)
    )


def first_load(rows: DataFrame, spec: History) -> DataFrame:
    """Every row becomes the current version of its key."""
    return rows.withColumns({
        "valid_from": F.col(spec.versioned_by),
        "valid_till": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
    })


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def classify(history: DataFrame, incoming: DataFrame, spec: History) -> DataFrame:
    """The incoming rows with their ``change_type``."""
    joined = incoming.alias("new").join(
        current(history).alias("old"), F.col(f"new.{spec.key}") == F.col(f"old.{spec.key}"), "left"
    )
    return joined.select("new.*", _change_type(spec).alias("change_type"))


def change_report(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change_type").agg(F.count(F.lit(1)).alias("row_count"))


def next_versions(history: DataFrame, incoming: DataFrame, spec: History) -> DataFrame:
    """Current versions after applying ``incoming``, plus the versions it closed.

    One full outer join on the key (unique on both sides) decides each row once; the row then turns into one version or,
    for a tracked change, into the closed and the opened one. Versions closed earlier are not read.
    """
    columns = [name for name in history.columns if name not in VALIDITY]
    old_side, new_side = current(history).alias("old"), incoming.alias("new")
    joined = old_side.join(new_side, F.col(f"old.{spec.key}") == F.col(f"new.{spec.key}"), "full")
    change = F.col("__change")

    def version(values: list[Column], valid_from: Column, valid_till: Column, is_current: Column) -> Column:
        named = [value.alias(name) for value, name in zip(values, columns)]
        return F.struct(
            *named, valid_from.alias("valid_from"), valid_till.alias("valid_till"), is_current.alias("is_current")
        )

    def kept_value(name: str) -> Column:
        mine = F.col(f"old.{name}")
        return F.when(change == TYPE_1, F.col(f"new.{name}")).otherwise(mine) if name in spec.overwritten else mine

    kept = version(
        [kept_value(name) for name in columns], F.col("old.valid_from"), F.col("old.valid_till"), F.lit(True)
    )
    changed_at = F.col(f"new.{spec.versioned_by}")
    opened = version(
        [F.col(f"new.{name}") for name in columns], changed_at, F.lit(None).cast("timestamp"), F.lit(True)
    )
    closed = version([F.col(f"old.{name}") for name in columns], F.col("old.valid_from"), changed_at, F.lit(False))
    versions = (
        F.when(change == NEW, F.array(opened))
        .when(change == TYPE_2, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    return joined.withColumn("__change", _change_type(spec)).select(F.inline(versions)).select(*history.columns)


def apply_changes(history: DataFrame, incoming: DataFrame, spec: History) -> DataFrame:
    """The complete next history in one plan."""
    closed_before = history.where(~F.col("is_current"))
    return closed_before.unionByName(next_versions(history, incoming, spec))


def versions_of(changes: DataFrame, spec: History) -> DataFrame:
    """The history that all accepted rows of each key make up, in whatever order they came in.

    The rows of a key are put in order of their time (rows without one first; of rows with the same time the first one by
    all columns counts). A row whose tracked columns equal those of the row before belongs to the same version: the first one
    opens it and gives its values, the last one its corrected columns. One shuffle, by key; a key has as many rows as
    there were batches with it.
    """
    columns = changes.columns
    rest = [F.asc_nulls_last(name) for name in columns if name not in (spec.key, spec.versioned_by)]
    time = F.asc_nulls_first(spec.versioned_by)
    same_time = Window.partitionBy(spec.key, spec.versioned_by).orderBy(*rest)
    by_time = Window.partitionBy(spec.key).orderBy(time)
    before = [F.lag(name).over(by_time).alias(f"__{name}") for name in spec.tracked]
    gathered = changes.repartition(spec.key)
    rows = gathered.withColumn("__nth", F.row_number().over(same_time)).where("__nth = 1")
    first = F.row_number().over(by_time) == 1
    rows = rows.select(*columns, *before, first.alias("__first"))
    differs = reduce(lambda a, b: a | b, [~F.col(n).eqNullSafe(F.col(f"__{n}")) for n in spec.tracked])
    rows = rows.withColumn("__version", F.count_if(F.col("__first") | differs).over(by_time))
    values = [
        (F.max_by if name in spec.overwritten else F.min_by)(F.struct(name), F.col("__nth"))[name].alias(name)
        for name in columns if name != spec.key
    ]
    numbered = rows.withColumn("__nth", F.row_number().over(by_time))
    versions = numbered.groupBy(spec.key, "__version").agg(*values)
    in_turn = Window.partitionBy(spec.key).orderBy("__version")
    return versions.select(
        *columns, F.col(spec.versioned_by).alias("valid_from"),
        F.lead(spec.versioned_by).over(in_turn).alias("valid_till"),
        F.lead("__version").over(in_turn).isNull().alias("is_current"),
    )
