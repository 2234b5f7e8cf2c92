"""The given data make every rule fail, every spelling occur and both branches of the upserts run."""

from __future__ import annotations

import pytest

from compare import duckdb_on
from ledgerline.plans import cleaning
from workload import expected, inputs

SQL = expected.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return duckdb_on("/root/testdata/sf0.01")


def column(oracle, sql):
    return {row[0] for row in oracle.execute(sql).fetchall()}


def test_every_reason_occurs(spark, oracle):
    lists = column(oracle, f"SELECT failed_reasons FROM ({SQL['dq_all_reasons']}) t")
    seen = {reason for text in lists for reason in text.split("; ")}
    # Amounts out of range are kept out of the views: they could not be compared as exact sums.
    assert seen == {rule.reason for rule in cleaning.transaction_rules()} - {"Amount Out Of Range"}
    first = column(oracle, f"SELECT failed_reason FROM ({SQL['dq_first_reason']}) t")
    rules = cleaning.merchant_rules() + cleaning.customer_rules() + cleaning.card_rules()
    assert first == {rule.reason for rule in rules} - {"credit_limit_out_of_range"}


def test_every_spelling_occurs(oracle):
    codes = oracle.execute(f"SELECT currency, currency_code FROM ({SQL['currency_normalise']}) t").fetchall()
    assert {code for _, code in codes} == {"INR", "USD", "JPY", "GBP", "XYZ", None}
    assert {"$", "₹", "£ ", "¥", "Yen", "Jpy", "gbp", "usd", " inr"} <= {text for text, _ in codes}
    brands = column(oracle, f"SELECT card_brand_type FROM ({SQL['clean_cards']}) t")
    assert brands == {"RuPay", "Visa", "Mastercard", "Diners Club"}


@pytest.mark.parametrize("view, key", [
    (inputs.MERCHANTS, "merchant_id"), (inputs.CUSTOMERS, "customer_id"), (inputs.CARDS, "card_id"),
    (inputs.TRANSACTIONS, "transaction_id"),
])
def test_missing_and_padded_keys_occur(oracle, view, key):
    missing, padded, total = oracle.execute(
        f"SELECT count(*) FILTER ({key} IS NULL), count(*) FILTER ({key} <> trim({key})), count(*) FROM ({inputs.view_sql(view)}) v"
    ).fetchone()
    assert 0 < missing < total / 20 and 0 < padded < total / 5


@pytest.mark.parametrize("view, key", [(inputs.MERCHANTS, "merchant_id"), (inputs.CUSTOMERS, "customer_id")])
def test_duplicates_occur(oracle, view, key):
    rows, keys = oracle.execute(f"SELECT count({key}), count(DISTINCT trim({key})) FROM ({inputs.view_sql(view)}) v").fetchone()
    assert rows > keys > rows / 2


def test_card_updates_meet_stored_and_new_keys(oracle):
    stored = column(oracle, f"SELECT trim(card_id) FROM ({inputs.view_sql(inputs.CARDS, inputs.FIRST_BATCH)}) v")
    incoming = column(oracle, f"SELECT card_id FROM ({inputs.view_sql(inputs.CARD_UPDATES, inputs.UPDATED_CARDS)}) v")
    assert 0.2 * len(stored) < len(stored & incoming) < 0.5 * len(stored) and incoming - stored
