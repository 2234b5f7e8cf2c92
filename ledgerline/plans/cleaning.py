"""Bronze to Silver: standardise, keep one row per key, check references, describe good rows.

Every ``clean_*`` returns Silver columns plus the boolean helper columns its rules need; ``*_rules`` lists the rules in
the order in which reasons are reported. ``keep_keyless=False`` leaves out the rows without a key, which never pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.business import amount_sign_ok
from ledgerline.functions.money import in_range
from ledgerline.functions.text import (
    accepted_currency,
    card_network,
    currency_code,
    key_text,
    tidy_currency,
    titled,
    trimmed,
)
from ledgerline.operators.dedup import newest_per_key
from ledgerline.operators.history import History
from ledgerline.operators.quality import Rule
from ledgerline.operators.references import Reference

CheckReferences = Callable[[DataFrame, list[Reference]], DataFrame]

LINEAGE = ("silver_processed_at", "data_source")

CUSTOMER_HISTORY = History(
    key="customer_id",
    versioned_by="updated_at",
    tracked=("customer_status", "customer_city", "income_bucket", "occupation", "risk_grade"),
    overwritten=("customer_name", "total_cards_issued"),
)

# Columns an update changes; all others keep the value of the first load.
CARD_UPDATES = (
    "card_name", "card_rewards_category", "card_status", "credit_limit", "updated_at", "silver_processed_at",
)
TRANSACTION_UPDATES = (
    "transaction_status", "transaction_type", "transaction_timestamp", "updated_at", "silver_processed_at",
)


def with_lineage(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return df.withColumns({
        "silver_processed_at": F.current_timestamp() if processed_at is None else processed_at,
        "data_source": F.lit("bronze"),
    })


# -- merchants ---------------------------------------------------------------------------------------------------------

def standardise_merchants(raw: DataFrame) -> DataFrame:
    return raw.select(
        key_text("merchant_id").alias("merchant_id"),
        titled("merchant_name").alias("merchant_name"),
        titled("merchant_category").alias("merchant_category"),
        titled("country").alias("merchant_home_country"),
        trimmed("mcc_code").alias("mcc_code"),
        titled("merchant_city").alias("merchant_city"),
    )


def clean_merchants(raw: DataFrame, processed_at: Column | None = None, keep_keyless: bool = True) -> DataFrame:
    newest = newest_per_key(raw, "merchant_id", standardise_merchants, keep_keyless=keep_keyless)
    return with_lineage(newest, processed_at)


def merchant_rules() -> list[Rule]:
    return [  # the reasons are fixed values
        Rule("merchant_id_missing", F.col("merchant_id").isNotNull()),
        Rule("merchant_name_missing", F.col("merchant_name").isNotNull()),
    ]


# -- customers ---------------------------------------------------------------------------------------------------------

def standardise_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        key_text("customer_id").alias("customer_id"),
        titled("customer_name").alias("customer_name"),
        titled("customer_status").alias("customer_status"),
        trimmed("income").alias("income_bucket"),
        "total_cards_issued",
        F.col("joining_date").try_cast("date").alias("joining_date"),
        titled("city").alias("customer_city"),
        titled("occupation").alias("occupation"),
        titled("risk_grade").alias("risk_grade"),
        F.col("updated_at").try_cast("timestamp").alias("updated_at"),
    )


def clean_customers(raw: DataFrame, processed_at: Column | None = None, keep_keyless: bool = True) -> DataFrame:
    newest = newest_per_key(raw, "customer_id", standardise_customers, ["updated_at"], keep_keyless)
    return with_lineage(newest, processed_at)


def customer_rules() -> list[Rule]:
    return [  # the reasons are fixed values
        Rule("customer_id_missing", F.col("customer_id").isNotNull()),
        Rule("customer_name_missing", F.col("customer_name").isNotNull()),
    ]


# -- cards -------------------------------------------------------------------------------------------------------------

def standardise_cards(raw: DataFrame) -> DataFrame:
    # two steps, so that a text used more than once is computed once per row
    tidy = raw.select(
        key_text("card_id").alias("card_id"),
        titled("card_name").alias("card_name"),
        F.lower("card_name").alias("lower_name"),
        "card_brand_type",
        key_text("card_holder_id").alias("card_holder_id"),
        titled("card_holder_type").alias("card_holder_type"),
        titled("card_rewards_category").alias("card_rewards_category"),
        titled("card_status").alias("card_status"),
        "credit_limit",
        F.col("expiry_date").try_cast("date").alias("expiry_date"),
        F.col("updated_at").try_cast("timestamp").alias("updated_at"),
    )
    brand = card_network(F.col("lower_name"), titled("card_brand_type"))
    return tidy.withColumn("card_brand_type", brand).drop("lower_name")


def card_references(customer_keys: DataFrame) -> list[Reference]:
    return [Reference("card_holder_id", customer_keys, "holder_known")]


def clean_cards(
    raw: DataFrame,
    customer_keys: DataFrame,
    check: CheckReferences,
    processed_at: Column | None = None,
    keep_keyless: bool = True,
) -> DataFrame:
    newest = newest_per_key(raw, "card_id", standardise_cards, ["updated_at"], keep_keyless)
    return with_lineage(check(newest, card_references(customer_keys)), processed_at)


def card_rules() -> list[Rule]:
    return [  # the reasons are fixed values
        Rule("card_id_missing", F.col("card_id").isNotNull()),
        Rule("cardholder_not_found", F.col("holder_known")),
        Rule("credit_limit_out_of_range", in_range(F.col("credit_limit"))),
    ]


CARD_HELPERS = ("holder_known",)


# -- transactions ------------------------------------------------------------------------------------------------------

def standardise_transactions(raw: DataFrame) -> DataFrame:
    tidy = raw.select(
        key_text("transaction_id").alias("transaction_id"),
        key_text("card_id").alias("card_id"),
        key_text("customer_id").alias("customer_id"),
        key_text("merchant_id").alias("merchant_id"),
        "amount",
        tidy_currency("currency").alias("currency"),
        trimmed("device_channel").alias("device_channel"),
        titled("status").alias("transaction_status"),
        titled("transaction_type").alias("transaction_type"),
        F.col("transaction_timestamp").try_cast("timestamp").alias("transaction_timestamp"),
        F.col("updated_at").try_cast("timestamp").alias("updated_at"),
    )
    return tidy.select(
        "transaction_id", "card_id", "customer_id", "merchant_id", "amount",
        currency_code(F.col("currency")).alias("currency"),
        "device_channel", "transaction_status", "transaction_type", "transaction_timestamp",
        amount_sign_ok(F.col("transaction_type"), F.col("amount")).alias("is_negative_amount_valid"),
        "updated_at",
    )


def transaction_references(
    customer_keys: DataFrame, card_keys: DataFrame, merchant_keys: DataFrame
) -> list[Reference]:
    return [
        Reference("customer_id", customer_keys, "customer_known"),
        Reference("card_id", card_keys, "card_known"),
        Reference("merchant_id", merchant_keys, "merchant_known"),
    ]


def clean_transactions(
    raw: DataFrame,
    customer_keys: DataFrame,
    card_keys: DataFrame,
    merchant_keys: DataFrame,
    check: CheckReferences,
    processed_at: Column | None = None,
    keep_keyless: bool = True,
) -> DataFrame:
    newest = newest_per_key(raw, "transaction_id", standardise_transactions, ["updated_at"], keep_keyless)
    checked = check(newest, transaction_references(customer_keys, card_keys, merchant_keys))
    return with_lineage(checked, processed_at)


def transaction_rules() -> list[Rule]:
    return [  # the reasons are fixed values
        Rule("Missing Transaction ID", F.col("transaction_id").isNotNull()),
        Rule("Missing Transaction Amount", F.col("amount").isNotNull()),
        Rule("Invalid Negative Amount Flag", F.col("is_negative_amount_valid")),
        Rule("Missing or Inactive Customer Profile", F.col("customer_known")),
        Rule("Card Reference Not Found", F.col("card_known")),
        Rule("Merchant Profile Not Found", F.col("merchant_known")),
        Rule("Unsupported or Invalid Currency", accepted_currency(F.col("currency"))),
        Rule("Amount Out Of Range", in_range(F.col("amount"))),
    ]


TRANSACTION_HELPERS = ("customer_known", "card_known", "merchant_known")
