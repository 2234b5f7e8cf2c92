"""The given tables seen as landed card-business records.

Each view is SQL text that Spark and DuckDB both run: orders act as cards, line items as transactions (with genuine
duplicates), parts as merchants and customers as customers. Expressions on keys inject failing rows; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "customer", "part", "orders", "lineitem")

# Rows after this moment form the second batch, together with the expensive older ones, which arrive late.
CUTOFF = "1999-06-30 00:00:00"
LATE_PRICE = 400000
FIRST_BATCH = f"o_orderdate <= CAST('{CUTOFF}' AS {{ts}}) AND o_totalprice <= {LATE_PRICE}"
SECOND_BATCH = f"(o_orderdate > CAST('{CUTOFF}' AS {{ts}}) OR o_totalprice > {LATE_PRICE})"
EVERYTHING = "1 = 1"
# Cards of which a later state arrives: about a third of the stored ones, and new ones.
UPDATED_CARDS = f"({SECOND_BATCH} OR o_orderkey % 3 = 0)"

MERCHANT_ROWS = """
SELECT CASE WHEN p_partkey % 89 = 0 THEN CAST(NULL AS STRING)
            WHEN p_partkey % 83 = 0 THEN '   '
            WHEN p_partkey % 17 = 0 THEN concat(' ', CAST(p_partkey AS STRING), ' ')
            ELSE CAST(p_partkey AS STRING) END AS merchant_id,
       CASE WHEN p_partkey % 97 = 0 THEN CAST(NULL AS STRING) ELSE concat('  ', p_name, ' ') END AS merchant_name,
       lower(p_type) AS merchant_category,
       n_name AS country,
       p_brand AS mcc_code,
       n_name AS merchant_city
FROM {part} JOIN {nation} ON n_nationkey = p_partkey % 25
"""
MERCHANTS = f"{MERCHANT_ROWS} UNION ALL {MERCHANT_ROWS} WHERE p_partkey % 13 = 0"

CUSTOMER_ROWS = """
SELECT CASE WHEN c_custkey % 67 = 0 THEN CAST(NULL AS STRING)
            WHEN c_custkey % 71 = 0 THEN '  '
            WHEN c_custkey % 19 = 0 THEN concat(' ', CAST(c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END AS customer_id,
       CASE WHEN c_custkey % 61 = 0 THEN CAST(NULL AS STRING) ELSE c_name END AS customer_name,
       CASE WHEN c_custkey % 20 = 0 THEN 'Blocked' WHEN c_custkey % 10 = 5 THEN 'Dormant' ELSE 'Active' END
           AS customer_status,
       CASE WHEN c_acctbal < 2500 THEN 'Low' WHEN c_acctbal < 7500 THEN 'Mid' ELSE 'Top' END AS income,
       order_count AS total_cards_issued,
       CAST(first_order AS DATE) AS joining_date,
       n_name AS city,
       lower(c_mktsegment) AS occupation,
       CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_grade,
       last_order AS updated_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS order_count, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM {orders} GROUP BY o_custkey) per_customer ON o_custkey = c_custkey
"""
# Some customers are there twice, with an older address.
CUSTOMERS = f"""{CUSTOMER_ROWS} UNION ALL
SELECT customer_id, customer_name, customer_status, income, total_cards_issued, joining_date, 'old town' AS city, occupation,
       risk_grade, updated_at - INTERVAL '30' DAY AS updated_at
FROM ({CUSTOMER_ROWS}) older WHERE total_cards_issued % 5 = 0
"""

# One record per order: the customer as known at that moment.
CUSTOMER_UPDATES = """
SELECT CAST(o_custkey AS STRING) AS customer_id,
       c_name AS customer_name,
       o_orderstatus AS customer_status,
       o_orderpriority AS income,
       CAST(o_orderkey % 4 AS BIGINT) AS total_cards_issued,
       CAST('1995-01-01' AS DATE) AS joining_date,
       n_name AS city,
       lower(c_mktsegment) AS occupation,
       CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 3000 THEN 'Medium' ELSE 'Low' END AS risk_grade,
       o_orderdate AS updated_at
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE {where}
"""

CARDS = """
SELECT CASE WHEN o_orderkey % 103 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 107 = 0 THEN ' ' WHEN o_orderkey % 29 = 0
            THEN concat(CAST(o_orderkey AS STRING), ' ') ELSE CAST(o_orderkey AS STRING) END AS card_id,
       concat(CASE WHEN o_orderkey % 7 = 0 THEN 'Store' WHEN o_orderkey % 3 = 0 THEN 'RuPay' WHEN o_orderkey % 3 = 1 THEN 'Visa' ELSE 'Mastercard' END,
              ' ', o_orderpriority) AS card_name,
       'diners club' AS card_brand_type,
       CASE WHEN o_orderkey % 101 = 0 THEN 'missing' ELSE CAST(o_custkey AS STRING) END AS card_holder_id,
       CASE WHEN o_orderkey % 5 < 3 THEN 'Consumer' WHEN o_orderkey % 5 = 3 THEN 'Commercial' ELSE 'Corporate' END
           AS card_holder_type,
       lower(o_orderpriority) AS card_rewards_category,
       CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Blocked' ELSE 'Lost' END AS card_status,
       CASE WHEN o_orderkey % 509 = 0 THEN CAST(1e15 AS DOUBLE) ELSE o_totalprice / 20 END AS credit_limit,
       CAST(o_orderdate AS DATE) AS expiry_date,
       o_orderdate AS updated_at
FROM {orders}
WHERE {where}
"""

# A later state of the same cards: another limit, status and expiry date.
CARD_UPDATES = """
SELECT CAST(o_orderkey AS STRING) AS card_id,
       concat('Visa ', o_orderpriority) AS card_name,
       'Unknown' AS card_brand_type,
       CAST(o_custkey AS STRING) AS card_holder_id,
       'Corporate' AS card_holder_type,
       o_orderpriority AS card_rewards_category,
       ' lost' AS card_status,
       o_totalprice / 10 AS credit_limit,
       CAST(o_orderdate + INTERVAL '365' DAY AS DATE) AS expiry_date,
       o_orderdate + INTERVAL '365' DAY AS updated_at
FROM {orders}
WHERE {where}
"""

TRANSACTIONS = """
SELECT CASE WHEN l_orderkey % 211 = 0 THEN CAST(NULL AS STRING) WHEN l_orderkey % 223 = 0 THEN '    '
            ELSE concat(CASE WHEN l_orderkey % 37 = 0 THEN ' ' ELSE '' END, CAST(l_orderkey AS STRING), '-',
                        CAST(l_linenumber AS STRING)) END AS transaction_id,
       CAST(l_orderkey AS STRING) AS card_id,
       CAST(o_custkey AS STRING) AS customer_id,
       CAST(l_partkey AS STRING) AS merchant_id,
       CASE WHEN l_partkey % 31 = 0 THEN CAST(NULL AS DOUBLE) WHEN l_partkey % 101 = 0 THEN CAST(1e15 AS DOUBLE) ELSE l_extendedprice * (CASE WHEN o_custkey % 50 = 0 THEN CAST(4.0 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END)
           * (CASE WHEN l_returnflag = 'R' AND l_suppkey % 11 <> 0 THEN -1 ELSE 1 END) END AS amount,
       CASE (l_suppkey + l_linenumber) % 16
            WHEN 0 THEN ' inr' WHEN 1 THEN '$' WHEN 2 THEN 'Yen' WHEN 3 THEN 'xyz' WHEN 4 THEN CAST(NULL AS STRING)
            WHEN 5 THEN 'gbp' WHEN 6 THEN '£ ' WHEN 7 THEN '₹' WHEN 8 THEN '¥' WHEN 9 THEN 'Jpy'
            WHEN 10 THEN 'usd' ELSE 'INR' END AS currency,
       'pos' AS device_channel,
       CASE l_linestatus WHEN 'F' THEN 'successful' ELSE 'pending' END AS status,
       CASE l_returnflag WHEN 'R' THEN 'Refund' WHEN 'A' THEN 'EMI Conversion' ELSE 'Purchase' END
           AS transaction_type,
       l_shipdate AS transaction_timestamp,
       l_shipdate AS updated_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
WHERE {where}
"""
FIRST_TRANSACTIONS = f"l_shipdate <= CAST('{CUTOFF}' AS {{ts}})"
SECOND_TRANSACTIONS = f"l_shipdate > CAST('{CUTOFF}' AS {{ts}})"


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}


def view(spark: SparkSession, given: dict[str, DataFrame], text: str, where: str = EVERYTHING) -> DataFrame:
    """Run one of the views above on the given tables."""
    used = {name: given[name] for name in TABLES if f"{{{name}}}" in text}
    return spark.sql(text.replace("{where}", where.format(ts="TIMESTAMP_NTZ")), **used)


def view_sql(text: str, where: str = EVERYTHING) -> str:
    """The same view for DuckDB, where the tables are registered by name."""
    return text.format(**{name: name for name in TABLES}, where=where.format(ts="TIMESTAMP"))
