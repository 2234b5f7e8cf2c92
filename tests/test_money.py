"""Amounts are summed exactly to the stated precision; what cannot be summed is quarantined, the mart never stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.money import as_double, in_range, total
from ledgerline.plans import cleaning, marts
from ledgerline.operators import quality


def test_more_than_four_places_and_large_amounts(rows):
    def summed(*amounts):
        return rows("amount double", *[(a,) for a in amounts]).agg(as_double(total(F.col("amount"))).alias("t")).first()["t"]

    assert summed(10.5, 10.123456) == 20.623456
    assert summed(*[0.1] * 1000) == 100.0
    assert summed(9e14, 0.0000000001, None) == 900000000000000.0
    assert summed(None) is None


def test_range_rule(rows):
    df = rows("k string, amount double", *[(k, float(v) if v is not None else None) for k, v in {
        "fine": 1e14, "none": None, "large": 1e15, "inf": "inf", "minus": "-inf", "nan": "nan"}.items()])
    assert {r.k for r in df.where(in_range(F.col("amount"))).collect()} == {"fine", "none"}
    reasons = [rule for rule in cleaning.transaction_rules() if rule.reason == "Amount Out Of Range"]
    assert quality.assess(df, reasons).where(~F.col(quality.VALID)).count() == 4


def test_the_mart_sums_what_silver_lets_through(rows):
    facts = rows("customer_id string, month date, merchant_id string, amount double, transaction_type string, merchant_category string",
                 *[("c", None, "m", 9.9e14, "Purchase", "x")] * 50, ("c", None, "m", 0.123456, "Purchase", "x"))
    assert marts.monthly_spend(facts).first()["total_spend"] == 4.95e16
