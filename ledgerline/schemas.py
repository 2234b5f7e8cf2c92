"""Fixed schemas. Nothing is inferred from data, so two runs can never disagree about a type."""

from __future__ import annotations

from pyspark.sql import types as T


def text_record(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Landed records. Everything arrives as text, so that a value of the wrong type is seen and named, not lost.
MERCHANT_RECORD = text_record(
    "merchant_id", "merchant_name", "merchant_category", "country", "mcc_code", "merchant_city"
)
CUSTOMER_RECORD = text_record(
    "customer_id", "customer_name", "customer_status", "income", "total_cards_issued", "joining_date", "city",
    "occupation", "risk_grade", "updated_at",
)
CARD_RECORD = text_record(
    "card_id", "card_name", "card_brand_type", "card_holder_id", "card_holder_type", "card_rewards_category",
    "card_status", "credit_limit", "expiry_date", "updated_at",
)
TRANSACTION_RECORD = text_record(
    "transaction_id", "card_id", "customer_id", "merchant_id", "amount", "currency", "device_channel", "status",
    "transaction_type", "transaction_timestamp", "updated_at",
)

# Types that landed text must be readable as; the first group is stored with its type, dates stay text until cleaning.
STORED_TYPES = {
    "total_cards_issued": "bigint", "credit_limit": "double", "amount": "double", "updated_at": "timestamp",
}
READABLE_AS = STORED_TYPES | {
    "joining_date": "date", "expiry_date": "date", "transaction_timestamp": "timestamp",
}

CORRUPT = "_corrupt_record"


def page_of(record: T.StructType) -> T.StructType:
    """One landed page of an endpoint: {"data": [record, ...], "count": n}, or its text where it is not such a page."""
    return T.StructType([
        T.StructField("data", T.ArrayType(record)), T.StructField("count", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ])


PIPELINE_METADATA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_processed_timestamp", T.TimestampType(), True),
])

# Fixed values: (pipeline, table) pairs whose progress is tracked from the start.
TRACKED_TABLES = (
    ("ingest_to_bronze", "bronze_merchants"),
    ("ingest_to_bronze", "bronze_customers"),
    ("ingest_to_bronze", "bronze_cards"),
    ("ingest_to_bronze", "bronze_transactions"),
    ("bronze_to_silver", "silver_merchants"),
    ("bronze_to_silver", "silver_customers"),
    ("bronze_to_silver", "silver_cards"),
    ("bronze_to_silver", "silver_transactions"),
    ("silver_to_gold", "customers_spend_summary"),
    ("silver_to_gold", "portfolio_risk_summary"),
    ("silver_to_gold", "customer_segmentation_summary"),
)

# The metadata with what the stages need to go on after a crash (see plans.progress).
PROGRESS = T.StructType([
    *PIPELINE_METADATA.fields,
    T.StructField("batch", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("pending", T.LongType()),
    T.StructField("staged", T.BooleanType()),
    T.StructField("table_schema", T.StringType()),
])
