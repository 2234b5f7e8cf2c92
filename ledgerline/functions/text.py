"""Standardisation of text columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that name a currency wherever they occur in the field, first match wins. They are not anchored on
# purpose: "US$" and "USDT" both count as USD.
CURRENCY_SPELLINGS = (
    ("USD", ("USD", "$")),
    ("INR", ("INR", "₹")),
    ("GBP", ("GBP", "£")),
    ("JPY", ("YEN", "JPY", "¥")),
)

# Currencies accepted by the transaction rules.
ACCEPTED_CURRENCIES = (
    "INR", "USD", "JPY", "THB", "SGD", "GBP", "AED", "EUR", "KWD", "BHD", "OMR", "CAD", "CNY",
)

# Card networks looked for in a card name, first match wins.
CARD_NETWORKS = ("RuPay", "Visa", "Mastercard")


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def key_text(name: str) -> Column:
    """A key as it is compared; a blank one is no key."""
    return F.nullif(trimmed(name), F.lit(""))


def titled(name: str) -> Column:
    return F.initcap(F.trim(F.col(name)))


def tidy_currency(name: str) -> Column:
    return F.upper(trimmed(name))


def _holds_any(text: Column, parts: Iterable[str]) -> Column:
    """Plain substring tests: several times faster than a regular expression of alternatives."""
    return reduce(lambda a, b: a | b, [text.contains(part) for part in parts])


def currency_code(tidy: Column) -> Column:
    """ISO code for the known spellings in a tidied field; anything else is kept."""
    known = [F.when(_holds_any(tidy, parts), F.lit(code)) for code, parts in CURRENCY_SPELLINGS]
    return F.coalesce(*known, tidy)


def accepted_currency(code: Column) -> Column:
    return _holds_any(code, ACCEPTED_CURRENCIES)


def card_network(lower_name: Column, fallback: Column) -> Column:
    """Network named in a lower-cased card name, else the given brand."""
    named = [F.when(lower_name.contains(network.lower()), F.lit(network)) for network in CARD_NETWORKS]
    return F.coalesce(*named, fallback)
