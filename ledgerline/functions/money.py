"""Sums of money that do not depend on the order in which rows arrive.

Adding doubles gives a slightly different total for every task order. Amounts are therefore added as decimals with ten
places and turned back into a double only in the result: a total is exact to ten places and then has a double's precision.
Amounts of 1e15 and more, infinities and NaN are not money; they go to quarantine before they reach a sum. A sum then has
room for more than 1e12 of the largest amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"
LIMIT = 1e15


def in_range(amount: Column) -> Column:
    """Whether the amount can be summed. NULL can: it adds nothing."""
    return amount.isNull() | (F.abs(amount) < LIMIT)


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(amount: Column) -> Column:
    """Aggregate: exact decimal sum."""
    return F.sum(money(amount))


def as_double(amount: Column) -> Column:
    return amount.cast("double")
