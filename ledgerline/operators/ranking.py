"""Best value per group by an aggregate, with ties decided by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def best(value: Column, score: Column, only_if: Column | None = None) -> Column:
    """Aggregate: the value with the greatest score. Equal scores: the smaller value, a missing value last.

    ``only_if`` leaves rows out of the choice. As an aggregate it is combined before the shuffle.
    """
    rank = F.struct((-score).alias("score"), value.isNull().alias("unnamed"), value.alias("name"))
    return F.min_by(value, rank if only_if is None else F.when(only_if, rank))
