"""Rule-based validation: which rows pass, and why the others do not."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = "is_valid"
REASONS = "failed_reasons"


class Rule(NamedTuple):
    """A condition every good row meets and the reason recorded when a row does not. NULL counts as not met."""

    reason: str
    met: Column


def _met(rule: Rule) -> Column:
    return F.coalesce(rule.met, F.lit(False))


def assess(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the verdict and, for failed rows, all failure reasons in rule order.

    The verdict is a plain conjunction, which Spark compiles and can use in joins; the list is built for failed rows only.
    """
    verdict = reduce(lambda a, b: a & b, [_met(rule) for rule in rules])
    reasons = F.array_compact(F.array(*[F.when(~_met(rule), F.lit(rule.reason)) for rule in rules]))
    return df.withColumns({REASONS: F.when(~verdict, reasons), VALID: verdict})


def good_rows(assessed: DataFrame) -> DataFrame:
    return assessed.where(F.col(VALID)).drop(VALID, REASONS)


def bad_rows(assessed: DataFrame) -> DataFrame:
    """Failed rows with every reason."""
    return assessed.where(~F.col(VALID)).drop(VALID)


def bad_rows_first_reason(assessed: DataFrame, column: str = "failed_reason") -> DataFrame:
    """Failed rows with the first reason only."""
    return bad_rows(assessed).withColumn(column, F.get(REASONS, F.lit(0))).drop(REASONS)


def report(loaded: DataFrame, assessed: DataFrame) -> DataFrame:
    """One row of counts and rates, from one aggregate over both inputs; no row leaves the executors."""
    marks = loaded.select(F.lit(None).cast("boolean").alias("passed"), F.lit(True).alias("raw")).unionByName(
        assessed.select(F.col(VALID).alias("passed"), F.lit(False).alias("raw"))
    )
    counts = marks.agg(
        F.count_if(F.col("raw")).alias("rows_loaded"),
        F.count_if(~F.col("raw")).alias("rows_entered"),
        F.count_if(F.col("passed")).alias("rows_passed"),
        F.count_if(~F.col("passed")).alias("rows_failed"),
    )

    def rate(name: str) -> Column:
        return F.when(F.col("rows_entered") > 0, F.col(name) / F.col("rows_entered") * 100).otherwise(0.0)

    return counts.select(
        "rows_loaded",
        (F.col("rows_loaded") - F.col("rows_entered")).alias("rows_removed"),
        "rows_entered", "rows_passed", "rows_failed",
        rate("rows_passed").alias("success_pct"),
        rate("rows_failed").alias("failure_pct"),
    )
