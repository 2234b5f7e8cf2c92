"""Predicates and formulas of the card business."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction types, compared without regard to case because cleaning changes the case of "EMI".
SPEND_TYPES = ("purchase", "emi conversion")
REFUND_TYPE = "refund"

# Upper bounds of the monthly-spend segments.
SPEND_SEGMENTS = (("Low", 5_000), ("Medium", 20_000), ("High", 60_000))

# Upper bounds of the utilization buckets; the last bucket takes the rest, missing values included.
UTILIZATION_BUCKETS = (("0-10%", 10), ("10-30%", 30), ("30-50%", 50), ("50-70%", 70))
UTILIZATION_REST = "70-100%"

HIGH_UTILIZATION_PCT = 80
CRORE = 10_000_000


def is_spend(transaction_type: Column) -> Column:
    return F.lower(transaction_type).isin(*SPEND_TYPES)


def is_refund(transaction_type: Column) -> Column:
    return F.lower(transaction_type) == REFUND_TYPE


def amount_sign_ok(transaction_type: Column, amount: Column) -> Column:
    """Refunds are negative, everything else is zero or more; an unknown type or amount is never right."""
    right = F.when(is_refund(transaction_type), amount < 0).otherwise(amount >= 0)
    return F.coalesce(transaction_type.isNotNull() & right, F.lit(False))


def month_of(timestamp: Column) -> Column:
    return F.date_trunc("month", timestamp).cast("date")


def percent_change(value: Column, before: Column) -> Column:
    """NULL when there is nothing to compare with."""
    return F.when(before != 0, (value - before) / before * 100)


def tenure_months(as_of: Column, joining_date: Column) -> Column:
    return F.round(F.months_between(as_of, joining_date))


def _first_bound(value: Column, bounds: tuple[tuple[str, int], ...]) -> list[Column]:
    return [F.when(value <= bound, F.lit(label)) for label, bound in bounds]


def spend_segment(avg_monthly_spend: Column) -> Column:
    above = F.when(avg_monthly_spend > SPEND_SEGMENTS[-1][1], F.lit("Very High"))
    return F.coalesce(*_first_bound(avg_monthly_spend, SPEND_SEGMENTS), above, F.lit("Unknown"))


def utilization_bucket(utilization_pct: Column) -> Column:
    return F.coalesce(*_first_bound(utilization_pct, UTILIZATION_BUCKETS), F.lit(UTILIZATION_REST))
