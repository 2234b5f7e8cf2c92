"""SQL for the rows every registered query must return, written for DuckDB.

The SQL states each result step by step (separate aggregates, joins and windows), not the way the Spark plans are fused.
Common table expressions are kept by name with the names they read; a query takes those it needs.
"""

from __future__ import annotations

import re

from workload import inputs
from workload.catalog import AS_OF

CTES: dict[str, str] = {}


def title(expression: str) -> str:
    words = f"string_split(lower(trim({expression})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def newest(source: str, key: str, columns: list[str], newest_first: str | None = "updated_at") -> str:
    """One row per key: newest first, ties by all other columns in order; rows without key are all kept."""
    first = [f"{newest_first} DESC NULLS LAST"] if newest_first else []
    order = ", ".join(first + [f"{c} ASC NULLS LAST" for c in columns if c != newest_first])
    names = ", ".join(columns)
    return f"""SELECT {names} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) ranked
        WHERE rn = 1 OR {key} IS NULL"""


MERCHANT_COLUMNS = ["merchant_id", "merchant_name", "merchant_category", "merchant_home_country", "mcc_code",
                    "merchant_city"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "customer_status", "income_bucket", "total_cards_issued",
                    "joining_date", "customer_city", "occupation", "risk_grade", "updated_at"]
CARD_COLUMNS = ["card_id", "card_name", "card_brand_type", "card_holder_id", "card_holder_type",
                "card_rewards_category", "card_status", "credit_limit", "expiry_date", "updated_at"]
TRANSACTION_COLUMNS = ["transaction_id", "card_id", "customer_id", "merchant_id", "amount", "currency",
                       "device_channel", "transaction_status", "transaction_type", "transaction_timestamp",
                       "is_negative_amount_valid", "updated_at"]
SILVER_TRANSACTION_COLUMNS = [c for c in TRANSACTION_COLUMNS if c != "is_negative_amount_valid"]

# -- merchants ---------------------------------------------------------------------------------------------------------

CTES["merchants_raw"] = inputs.view_sql(inputs.MERCHANTS)
CTES["merchants_std"] = f"""SELECT nullif(trim(merchant_id), '') AS merchant_id, {title('merchant_name')} AS merchant_name,
    {title('merchant_category')} AS merchant_category, {title('country')} AS merchant_home_country,
    trim(mcc_code) AS mcc_code, {title('merchant_city')} AS merchant_city FROM merchants_raw"""
CTES["merchants_clean"] = newest("merchants_std", "merchant_id", MERCHANT_COLUMNS, None)
CTES["merchants"] = "SELECT *, 'bronze' AS data_source FROM merchants_clean WHERE merchant_id IS NOT NULL AND merchant_name IS NOT NULL"
CTES["merchants_bad"] = """SELECT 'merchants' AS table_name, merchant_id AS row_key,
    CASE WHEN merchant_id IS NULL THEN 'merchant_id_missing' ELSE 'merchant_name_missing' END AS failed_reason
    FROM merchants_clean WHERE merchant_id IS NULL OR merchant_name IS NULL"""

# -- customers ---------------------------------------------------------------------------------------------------------


def add_customers(tag: str, view: str) -> None:
    CTES[f"customers_raw{tag}"] = view
    CTES[f"customers_std{tag}"] = f"""SELECT nullif(trim(customer_id), '') AS customer_id,
        {title('customer_name')} AS customer_name, {title('customer_status')} AS customer_status,
        trim(income) AS income_bucket, total_cards_issued, joining_date, {title('city')} AS customer_city,
        {title('occupation')} AS occupation, {title('risk_grade')} AS risk_grade, updated_at
        FROM customers_raw{tag}"""
    CTES[f"customers_clean{tag}"] = (
        f"SELECT *, 'bronze' AS data_source FROM ({newest(f'customers_std{tag}', 'customer_id', CUSTOMER_COLUMNS)}) c"
    )


add_customers("", inputs.view_sql(inputs.CUSTOMERS))
add_customers("_all", inputs.view_sql(inputs.CUSTOMER_UPDATES))
add_customers("_1", inputs.view_sql(inputs.CUSTOMER_UPDATES, inputs.FIRST_BATCH))
add_customers("_2", inputs.view_sql(inputs.CUSTOMER_UPDATES, inputs.SECOND_BATCH))
CTES["customers"] = "SELECT * FROM customers_clean WHERE customer_id IS NOT NULL AND customer_name IS NOT NULL"
CTES["customers_bad"] = """SELECT 'customers' AS table_name, customer_id AS row_key,
    CASE WHEN customer_id IS NULL THEN 'customer_id_missing' ELSE 'customer_name_missing' END AS failed_reason
    FROM customers_clean WHERE customer_id IS NULL OR customer_name IS NULL"""

# history: the second batch against the first
CTES["changes"] = """SELECT n.*, CASE
      WHEN o.customer_id IS NULL THEN 'new'
      WHEN same_tracked AND same_rest THEN 'unchanged'
      WHEN n.updated_at <= o.updated_at THEN 'stale'
      WHEN NOT same_tracked THEN 'type2' ELSE 'type1' END AS change_type
    FROM customers_clean_2 n LEFT JOIN customers_clean_1 o ON n.customer_id = o.customer_id
    CROSS JOIN LATERAL (SELECT
      n.customer_status IS NOT DISTINCT FROM o.customer_status
      AND n.customer_city IS NOT DISTINCT FROM o.customer_city
      AND n.income_bucket IS NOT DISTINCT FROM o.income_bucket
      AND n.occupation IS NOT DISTINCT FROM o.occupation
      AND n.risk_grade IS NOT DISTINCT FROM o.risk_grade AS same_tracked,
      n.customer_name IS NOT DISTINCT FROM o.customer_name
      AND n.total_cards_issued IS NOT DISTINCT FROM o.total_cards_issued AS same_rest) compared"""
_KEPT = ", ".join(
    f"CASE WHEN n.change_type = 'type1' THEN n.{c} ELSE o.{c} END AS {c}"
    if c in ("customer_name", "total_cards_issued") else f"o.{c}" for c in CUSTOMER_COLUMNS
)
_OLD = ", ".join(f"o.{c}" for c in CUSTOMER_COLUMNS)
_NEW = ", ".join(CUSTOMER_COLUMNS)
CTES["history"] = f"""
    SELECT {_KEPT}, o.data_source, o.updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_till, TRUE AS is_current
    FROM customers_clean_1 o LEFT JOIN changes n ON n.customer_id = o.customer_id
    WHERE n.change_type IS NULL OR n.change_type <> 'type2'
    UNION ALL
    SELECT {_OLD}, o.data_source, o.updated_at, n.updated_at, FALSE
    FROM customers_clean_1 o JOIN changes n ON n.customer_id = o.customer_id WHERE n.change_type = 'type2'
    UNION ALL
    SELECT {_NEW}, data_source, updated_at, CAST(NULL AS TIMESTAMP), TRUE FROM changes
    WHERE change_type IN ('new', 'type2')"""

# all versions from the accepted rows of both batches, whichever came first
_TRACKED = ("customer_status", "customer_city", "income_bucket", "occupation", "risk_grade")
_SAME = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER by_time" for c in _TRACKED)
_FIRST = ", ".join(
    f"{'last' if c in ('customer_name', 'total_cards_issued') else 'first'}({c} ORDER BY nth) AS {c}"
    for c in CUSTOMER_COLUMNS[1:] + ["data_source"]
)
CTES["customer_changes"] = "SELECT * FROM customers_clean_1 UNION ALL SELECT * FROM customers_clean_2"
CTES["customer_rows"] = f"""SELECT *, row_number() OVER by_time AS nth,
    CASE WHEN row_number() OVER by_time > 1 AND {_SAME} THEN 0 ELSE 1 END AS opens FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at ORDER BY {", ".join(
            f"{c} ASC NULLS LAST" for c in CUSTOMER_COLUMNS[1:-1] + ["data_source"])}) AS same_time FROM customer_changes) n
    WHERE same_time = 1 WINDOW by_time AS (PARTITION BY customer_id ORDER BY updated_at NULLS FIRST)"""
CTES["customer_islands"] = """SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY nth) AS island FROM customer_rows"""
CTES["versions"] = f"""SELECT *, updated_at AS valid_from, lead(updated_at) OVER later AS valid_till,
    lead(island) OVER later IS NULL AS is_current FROM (
        SELECT customer_id, island, {_FIRST} FROM customer_islands GROUP BY customer_id, island) v
    WINDOW later AS (PARTITION BY customer_id ORDER BY island)"""

# -- cards -------------------------------------------------------------------------------------------------------------


def brand(name: str, otherwise: str) -> str:
    tests = " ".join(
        f"WHEN contains(lower({name}), '{network.lower()}') THEN '{network}'"
        for network in ("RuPay", "Visa", "Mastercard")
    )
    return f"CASE {tests} ELSE {otherwise} END"


def add_cards(tag: str, view: str) -> None:
    CTES[f"cards_raw{tag}"] = view
    CTES[f"cards_std{tag}"] = f"""SELECT nullif(trim(card_id), '') AS card_id, {title('card_name')} AS card_name,
        {brand('card_name', title('card_brand_type'))} AS card_brand_type, nullif(trim(card_holder_id), '') AS card_holder_id,
        {title('card_holder_type')} AS card_holder_type, {title('card_rewards_category')} AS card_rewards_category,
        {title('card_status')} AS card_status, credit_limit, expiry_date, updated_at FROM cards_raw{tag}"""
    CTES[f"cards_newest{tag}"] = newest(f"cards_std{tag}", "card_id", CARD_COLUMNS)
    CTES[f"cards_clean{tag}"] = f"""SELECT k.*, 'bronze' AS data_source, c.customer_id IS NOT NULL AS holder_known
        FROM cards_newest{tag} k LEFT JOIN customers c ON c.customer_id = k.card_holder_id"""
    CTES[f"cards{tag}"] = f"""SELECT * EXCLUDE (holder_known) FROM cards_clean{tag}
        WHERE card_id IS NOT NULL AND holder_known AND NOT coalesce(abs(credit_limit) >= 1e15, FALSE)"""


add_cards("", inputs.view_sql(inputs.CARDS))
add_cards("_1", inputs.view_sql(inputs.CARDS, inputs.FIRST_BATCH))
add_cards("_2", inputs.view_sql(inputs.CARD_UPDATES, inputs.UPDATED_CARDS))
CTES["cards_bad"] = """SELECT * EXCLUDE (holder_known),
    CASE WHEN card_id IS NULL THEN 'card_id_missing' WHEN NOT holder_known THEN 'cardholder_not_found'
         ELSE 'credit_limit_out_of_range' END AS failed_reason
    FROM cards_clean WHERE card_id IS NULL OR NOT holder_known OR abs(credit_limit) >= 1e15"""


def upserted(stored: str, incoming: str, key: str, columns: list[str], updates: set[str]) -> str:
    values = ", ".join(
        f"CASE WHEN n.{key} IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" if c in updates else f"o.{c}"
        for c in columns
    )
    names = ", ".join(f"n.{c}" for c in columns)
    return f"""SELECT {values} FROM {stored} o LEFT JOIN {incoming} n ON n.{key} = o.{key}
        UNION ALL SELECT {names} FROM {incoming} n
        WHERE NOT EXISTS (SELECT 1 FROM {stored} o WHERE o.{key} = n.{key})"""


_CARD_UPDATES = {"card_name", "card_rewards_category", "card_status", "credit_limit", "updated_at"}
CTES["cards_upserted"] = upserted("cards_1", "cards_2", "card_id", CARD_COLUMNS + ["data_source"], _CARD_UPDATES)
CTES["cards_written"] = upserted("cards_std_1", "cards_std_2", "card_id", CARD_COLUMNS, _CARD_UPDATES)

# -- transactions ------------------------------------------------------------------------------------------------------

CURRENCY = """CASE WHEN regexp_matches(tidy, 'USD|\\$') THEN 'USD' WHEN regexp_matches(tidy, 'INR|₹') THEN 'INR'
    WHEN regexp_matches(tidy, 'GBP|£') THEN 'GBP' WHEN regexp_matches(tidy, 'YEN|JPY|¥') THEN 'JPY' ELSE tidy END"""
ACCEPTED = "INR|USD|JPY|THB|SGD|GBP|AED|EUR|KWD|BHD|OMR|CAD|CNY"
FAILURES = (
    ("transaction_id IS NULL", "Missing Transaction ID"),
    ("amount IS NULL", "Missing Transaction Amount"),
    ("NOT is_negative_amount_valid", "Invalid Negative Amount Flag"),
    ("NOT customer_known", "Missing or Inactive Customer Profile"),
    ("NOT card_known", "Card Reference Not Found"),
    ("NOT merchant_known", "Merchant Profile Not Found"),
    (f"NOT coalesce(regexp_matches(currency, '{ACCEPTED}'), FALSE)", "Unsupported or Invalid Currency"),
    ("abs(amount) >= 1e15", "Amount Out Of Range"),
)


def add_transactions(tag: str, view: str) -> None:
    CTES[f"transactions_raw{tag}"] = view
    CTES[f"transactions_std{tag}"] = f"""SELECT nullif(trim(transaction_id), '') AS transaction_id, nullif(trim(card_id), '') AS card_id,
        nullif(trim(customer_id), '') AS customer_id, nullif(trim(merchant_id), '') AS merchant_id, amount, {CURRENCY} AS currency,
        trim(device_channel) AS device_channel, {title('status')} AS transaction_status,
        {title('transaction_type')} AS transaction_type, transaction_timestamp,
        coalesce((lower(trim(transaction_type)) = 'refund' AND amount < 0)
              OR (lower(trim(transaction_type)) <> 'refund' AND amount >= 0), FALSE) AS is_negative_amount_valid,
        updated_at FROM (SELECT *, upper(trim(currency)) AS tidy FROM transactions_raw{tag}) r"""
    CTES[f"transactions_newest{tag}"] = newest(f"transactions_std{tag}", "transaction_id", TRANSACTION_COLUMNS)
    CTES[f"transactions_clean{tag}"] = f"""SELECT t.*, 'bronze' AS data_source,
        c.customer_id IS NOT NULL AS customer_known, k.card_id IS NOT NULL AS card_known,
        m.merchant_id IS NOT NULL AS merchant_known
        FROM transactions_newest{tag} t LEFT JOIN customers c ON c.customer_id = t.customer_id
        LEFT JOIN cards k ON k.card_id = t.card_id LEFT JOIN merchants m ON m.merchant_id = t.merchant_id"""
    reasons = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for test, reason in FAILURES)
    CTES[f"transactions_checked{tag}"] = f"""SELECT * EXCLUDE (customer_known, card_known, merchant_known),
        concat_ws('; ', {reasons}) AS failed_reasons FROM transactions_clean{tag}"""
    CTES[f"transactions{tag}"] = f"""SELECT * EXCLUDE (failed_reasons, is_negative_amount_valid)
        FROM transactions_checked{tag} WHERE failed_reasons = ''"""


add_transactions("", inputs.view_sql(inputs.TRANSACTIONS))
add_transactions("_1", inputs.view_sql(inputs.TRANSACTIONS, inputs.FIRST_TRANSACTIONS))
add_transactions("_2", inputs.view_sql(inputs.TRANSACTIONS, inputs.SECOND_TRANSACTIONS))
_TXN_UPDATES = {"transaction_status", "transaction_type", "transaction_timestamp", "updated_at"}
CTES["transactions_upserted"] = upserted(
    "transactions_1", "transactions_2", "transaction_id", SILVER_TRANSACTION_COLUMNS + ["data_source"], _TXN_UPDATES
)
CTES["transactions_written"] = upserted(
    "transactions_newest_1", "transactions_newest_2", "transaction_id", TRANSACTION_COLUMNS, _TXN_UPDATES
)

# -- Gold --------------------------------------------------------------------------------------------------------------

MONTH = "CAST(date_trunc('month', transaction_timestamp) AS DATE)"


def money_sum(amount: str) -> str:
    return f"CAST(sum(CAST({amount} AS DECIMAL(38,6))) AS DOUBLE)"


CTES["enriched"] = f"""SELECT t.transaction_id, t.customer_id, t.merchant_id, t.amount, t.transaction_type,
    {MONTH} AS month, m.merchant_category FROM transactions t LEFT JOIN merchants m ON m.merchant_id = t.merchant_id
    WHERE t.transaction_status = 'Successful'"""
CTES["spending"] = "SELECT * FROM enriched WHERE lower(transaction_type) IN ('purchase', 'emi conversion')"
CTES["monthly_spend"] = f"""SELECT customer_id, month, {money_sum('amount')} AS total_spend,
    count(transaction_id) AS transaction_count, {money_sum('amount')} / count(amount) AS avg_transaction_amount
    FROM spending GROUP BY customer_id, month"""
CTES["monthly_refunds"] = f"""SELECT customer_id, month, {money_sum('abs(amount)')} AS total_refunded
    FROM enriched WHERE lower(transaction_type) = 'refund' GROUP BY customer_id, month"""
CTES["category_spend"] = f"""SELECT customer_id, month, merchant_category, {money_sum('amount')} AS category_spend
    FROM spending GROUP BY customer_id, month, merchant_category"""
CTES["top_category"] = """SELECT customer_id, month, merchant_category AS top_merchant_category FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, month
        ORDER BY category_spend DESC, merchant_category ASC NULLS LAST) AS rn FROM category_spend) r WHERE rn = 1"""
_BY_MONTH = "OVER (PARTITION BY customer_id ORDER BY month)"
CTES["mom_change"] = f"""SELECT *, CASE WHEN prev_month_spend <> 0
    THEN (total_spend - prev_month_spend) / prev_month_spend * 100 END AS mom_spend_change_pct
    FROM (SELECT *, lag(total_spend) {_BY_MONTH} AS prev_month_spend FROM monthly_spend) m"""
CTES["trailing_avg"] = f"""SELECT customer_id, month, CASE
      WHEN l3 IS NOT NULL THEN (l3 + l2 + l1) / 3 WHEN l2 IS NOT NULL THEN (l2 + l1) / 2 ELSE l1 END
      AS trailing_3mo_avg_spend
    FROM (SELECT customer_id, month, lag(total_spend, 1) {_BY_MONTH} AS l1, lag(total_spend, 2) {_BY_MONTH} AS l2,
          lag(total_spend, 3) {_BY_MONTH} AS l3 FROM monthly_spend) l"""
CTES["spend"] = """SELECT m.customer_id, m.month, m.total_spend, m.transaction_count, m.avg_transaction_amount,
    coalesce(r.total_refunded, 0.0) AS total_refunded, c.top_merchant_category, m.prev_month_spend,
    m.mom_spend_change_pct, t.trailing_3mo_avg_spend,
    coalesce(m.total_spend > 2 * t.trailing_3mo_avg_spend, FALSE) AS is_anomalous_spend
    FROM mom_change m LEFT JOIN monthly_refunds r ON r.customer_id = m.customer_id AND r.month = m.month
    LEFT JOIN top_category c ON c.customer_id = m.customer_id AND c.month = m.month
    LEFT JOIN trailing_avg t ON t.customer_id = m.customer_id AND t.month = m.month"""
# the same mart on the transactions written in two batches
_SPEND_STEPS = ["enriched", "spending", "monthly_spend", "monthly_refunds", "category_spend", "top_category", "mom_change",
                "trailing_avg", "spend"]
for _step in _SPEND_STEPS:
    _text = re.sub(r"\b(FROM|JOIN) transactions\b", r"\1 transactions_upserted", CTES[_step])
    CTES[f"{_step}_2"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_SPEND_STEPS)})\b", r"\1 \2_2", _text)
CTES["card_rollup"] = f"""SELECT card_holder_id AS customer_id, {money_sum('credit_limit')} AS total_credit_limit,
    count(card_id) AS card_count,
    CAST(sum(CASE WHEN card_status IN ('Blocked', 'Lost') THEN 1 ELSE 0 END) AS BIGINT) AS blocked_or_lost_card_count
    FROM cards GROUP BY card_holder_id"""
CTES["current_month_spend"] = """SELECT customer_id, total_spend AS current_month_spend FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY month DESC) AS rn FROM spend) s WHERE rn = 1"""
CTES["risk_filled"] = """SELECT c.customer_id, c.risk_grade, c.customer_status,
    coalesce(k.total_credit_limit, 0.0) AS total_credit_limit, coalesce(k.card_count, 0) AS card_count,
    coalesce(k.blocked_or_lost_card_count, 0) AS blocked_or_lost_card_count,
    coalesce(s.current_month_spend, 0.0) AS current_month_spend
    FROM customers c LEFT JOIN card_rollup k ON k.customer_id = c.customer_id
    LEFT JOIN current_month_spend s ON s.customer_id = c.customer_id"""
CTES["risk"] = """SELECT *, risk_grade = 'High' OR customer_status IN ('Blocked', 'Dormant')
    OR credit_utilization_pct > 80 AS is_high_risk_flag
    FROM (SELECT *, CASE WHEN total_credit_limit > 0 THEN current_month_spend / total_credit_limit * 100 ELSE 0.0 END
          AS credit_utilization_pct FROM risk_filled) r"""


def mode_of(column: str, alias: str) -> str:
    return f"""SELECT card_holder_id AS customer_id, {column} AS {alias} FROM (
        SELECT card_holder_id, {column}, row_number() OVER (PARTITION BY card_holder_id
            ORDER BY count(card_id) DESC, {column} ASC NULLS LAST) AS rn
        FROM cards GROUP BY card_holder_id, {column}) c WHERE rn = 1"""


CTES["primary_card_type"] = mode_of("card_holder_type", "primary_card_type")
CTES["preferred_rewards"] = mode_of("card_rewards_category", "preferred_rewards_category")
CTES["avg_monthly_spend"] = f"""SELECT customer_id, {money_sum('total_spend')} / count(total_spend) AS avg_monthly_spend
    FROM spend GROUP BY customer_id"""
_TENURE = f"""round((year(DATE '{AS_OF}') - year(joining_date)) * 12 + (month(DATE '{AS_OF}') - month(joining_date))
    + (day(DATE '{AS_OF}') - day(joining_date)) / 31.0)"""
CTES["segments"] = f"""SELECT c.customer_id, c.customer_city, c.occupation, c.income_bucket, c.joining_date,
    CAST({_TENURE} AS DOUBLE) AS customer_tenure_months, t.primary_card_type, p.preferred_rewards_category,
    a.avg_monthly_spend, CASE WHEN a.avg_monthly_spend <= 5000 THEN 'Low' WHEN a.avg_monthly_spend <= 20000 THEN 'Medium'
      WHEN a.avg_monthly_spend <= 60000 THEN 'High' WHEN a.avg_monthly_spend > 60000 THEN 'Very High'
      ELSE 'Unknown' END AS spend_segment
    FROM customers c LEFT JOIN primary_card_type t ON t.customer_id = c.customer_id
    LEFT JOIN preferred_rewards p ON p.customer_id = c.customer_id
    LEFT JOIN avg_monthly_spend a ON a.customer_id = c.customer_id"""

# -- the queries -------------------------------------------------------------------------------------------------------

_MARKS = f"""SELECT 'bronze_to_silver' AS pipeline_name, 'silver_cards' AS table_name,
    max(updated_at) AS last_processed_timestamp FROM cards_raw_1
    UNION ALL SELECT 'bronze_to_silver', 'silver_transactions', max(updated_at) FROM transactions_raw_1
    UNION ALL SELECT 'bronze_to_silver', 'silver_customers', max(updated_at) FROM customers_raw_1"""
CTES["progress"] = f"""SELECT s.pipeline_name, s.table_name, m.last_processed_timestamp FROM (VALUES
    ('ingest_to_bronze', 'bronze_merchants'), ('ingest_to_bronze', 'bronze_customers'),
    ('ingest_to_bronze', 'bronze_cards'), ('ingest_to_bronze', 'bronze_transactions'),
    ('bronze_to_silver', 'silver_merchants'), ('bronze_to_silver', 'silver_customers'),
    ('bronze_to_silver', 'silver_cards'), ('bronze_to_silver', 'silver_transactions'),
    ('silver_to_gold', 'customers_spend_summary'), ('silver_to_gold', 'portfolio_risk_summary'),
    ('silver_to_gold', 'customer_segmentation_summary')) s (pipeline_name, table_name)
    LEFT JOIN ({_MARKS}) m ON m.pipeline_name = s.pipeline_name AND m.table_name = s.table_name"""
CTES["cards_raw_late"] = inputs.view_sql(inputs.CARDS, inputs.SECOND_BATCH)

_TXN_HELPERS = "customer_known, card_known, merchant_known"
_TXN_REFERENCES = f"SELECT transaction_id, {_TXN_HELPERS} FROM transactions_clean"
_CROSSING = """SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS month FROM (
    SELECT transaction_timestamp AS ts FROM transactions_newest_2
    UNION ALL SELECT transaction_timestamp FROM transactions_newest_1
    WHERE transaction_id IN (SELECT transaction_id FROM transactions_newest_2)) t"""
_DISTRIBUTION = "SELECT {column}, count(DISTINCT customer_id) AS customers FROM {mart} GROUP BY {column}"
_CUSTOMER_RAW = ["customer_id", "customer_name", "customer_status", "income", "total_cards_issued", "joining_date",
                 "city", "occupation", "risk_grade", "updated_at"]
_TXN_RAW = ["transaction_id", "card_id", "customer_id", "merchant_id", "amount", "currency", "device_channel",
            "status", "transaction_type", "transaction_timestamp", "updated_at"]
CTES["cards_raw_both"] = "SELECT * FROM cards_raw UNION ALL SELECT * FROM cards_raw_2"

FINAL: dict[str, str] = {
    "scan_transactions": "SELECT * FROM transactions_raw",
    "incremental_scan": f"SELECT * FROM transactions_raw WHERE updated_at > TIMESTAMP '{inputs.CUTOFF}'",
    "watermark_read": "SELECT last_processed_timestamp FROM progress WHERE table_name = 'silver_cards'",
    "watermark_advance": """SELECT 'bronze_to_silver' AS pipeline_name, 'silver_transactions' AS table_name,
        max(updated_at) AS last_processed_timestamp FROM transactions_clean""",
    "watermark_upsert": """SELECT pipeline_name, table_name, CASE WHEN table_name = 'silver_cards'
        THEN greatest(last_processed_timestamp, (SELECT max(updated_at) FROM cards_raw_late))
        ELSE last_processed_timestamp END AS last_processed_timestamp FROM progress""",
    "upsert_cards": "SELECT * FROM cards_written",
    "upsert_transactions": "SELECT * FROM transactions_written",
    "upsert_touched_months": _CROSSING,
    "landed_csv": "SELECT * FROM merchants_raw",
    "landed_pages": "SELECT * FROM transactions_raw",
    "stored_quarantine": """SELECT * FROM merchants_bad UNION ALL SELECT * FROM customers_bad
        UNION ALL SELECT 'cards', card_id, failed_reason FROM cards_bad
        UNION ALL SELECT 'transactions', transaction_id, failed_reasons FROM transactions_checked WHERE failed_reasons <> ''""",
    "dedup_merchants": newest(
        "merchants_raw", "merchant_id",
        ["merchant_id", "merchant_name", "merchant_category", "country", "mcc_code", "merchant_city"], None,
    ),
    "dedup_customers": newest("customers_raw_all", "customer_id", _CUSTOMER_RAW),
    "dedup_cards": newest("cards_raw_both", "card_id", CARD_COLUMNS),
    "dedup_transactions": newest("transactions_raw", "transaction_id", _TXN_RAW),
    "clean_merchants": "SELECT *, 'bronze' AS data_source FROM merchants_clean",
    "clean_customers": "SELECT * FROM customers_clean",
    "clean_cards": "SELECT * FROM cards_clean",
    "clean_transactions": "SELECT * FROM transactions_clean",
    "card_brand": f"SELECT card_id, card_name, {brand('card_name', 'card_brand_type')} AS card_brand_type FROM cards_raw",
    "amount_sign": """SELECT transaction_type, is_negative_amount_valid, count(*) AS row_count FROM transactions_std
        GROUP BY transaction_type, is_negative_amount_valid""",
    "currency_normalise": f"""SELECT currency, {CURRENCY} AS currency_code, count(*) AS row_count
        FROM (SELECT currency, upper(trim(currency)) AS tidy FROM transactions_raw) r GROUP BY 1, 2""",
    "cards_ref_check": "SELECT card_id, card_holder_id, holder_known FROM cards_clean",
    "txn_ref_check": _TXN_REFERENCES,
    "txn_ref_check_by_exception": _TXN_REFERENCES,
    "dq_good_rows": "SELECT * FROM transactions",
    "dq_bad_rows": "SELECT * FROM cards_bad",
    "dq_first_reason": """SELECT * FROM merchants_bad UNION ALL SELECT * FROM customers_bad
        UNION ALL SELECT 'cards', card_id, failed_reason FROM cards_bad""",
    "dq_all_reasons": "SELECT * FROM transactions_checked WHERE failed_reasons <> ''",
    "dq_report": """SELECT loaded AS rows_loaded, loaded - entered AS rows_removed, entered AS rows_entered,
        passed AS rows_passed, entered - passed AS rows_failed, passed / entered * 100 AS success_pct,
        (entered - passed) / entered * 100 AS failure_pct
        FROM (SELECT (SELECT count(*) FROM transactions_raw) AS loaded,
              (SELECT count(*) FROM transactions_checked) AS entered,
              (SELECT count(*) FROM transactions) AS passed) c""",
    "scd_initial": """SELECT *, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_till, TRUE AS is_current
        FROM customers_clean_all""",
    "scd_classify": "SELECT customer_id, updated_at, change_type FROM changes",
    "scd2_apply": "SELECT * FROM history WHERE customer_id IN (SELECT customer_id FROM history WHERE NOT is_current)",
    "scd1_apply": "SELECT * FROM history WHERE customer_id IN (SELECT customer_id FROM changes "
                  "WHERE change_type = 'type1')",
    "scd_report": "SELECT change_type, count(*) AS row_count FROM changes GROUP BY change_type",
    "scd_any_order": "SELECT * EXCLUDE (island) FROM versions",
    "change_counts": "SELECT change_type, count(*) AS row_count FROM changes GROUP BY change_type",
    "ingest_two_runs": """SELECT *, 1 AS ingest_batch FROM transactions_raw_1
        UNION ALL SELECT *, 2 FROM transactions_raw_2""",
    "pipeline_full": "SELECT * FROM risk",
    "gold_run_marks": """SELECT 'customers_spend_summary' AS table_name, count(*) AS row_count, TRUE AS has_run FROM spend
        UNION ALL SELECT 'portfolio_risk_summary', count(*), TRUE FROM risk
        UNION ALL SELECT 'customer_segmentation_summary', count(*), TRUE FROM segments""",
    "silver_merchants": "SELECT * FROM merchants",
    "silver_customers": "SELECT * FROM history",
    "silver_cards": "SELECT * FROM cards_upserted",
    "silver_transactions": "SELECT * FROM transactions_upserted",
    "txn_enrich": "SELECT * FROM enriched",
    "monthly_spend": "SELECT * FROM monthly_spend",
    "monthly_refunds": "SELECT * FROM monthly_refunds",
    "category_spend": "SELECT * FROM category_spend",
    "top_category": "SELECT * FROM top_category",
    "mom_change": "SELECT * FROM mom_change",
    "spend_anomaly": """SELECT m.*, t.trailing_3mo_avg_spend,
        coalesce(m.total_spend > 2 * t.trailing_3mo_avg_spend, FALSE) AS is_anomalous_spend
        FROM monthly_spend m JOIN trailing_avg t ON t.customer_id = m.customer_id AND t.month = m.month""",
    "card_rollup": "SELECT * FROM card_rollup",
    "current_month_spend": "SELECT * FROM current_month_spend",
    "primary_card_type": "SELECT * FROM primary_card_type",
    "preferred_rewards": "SELECT * FROM preferred_rewards",
    "card_preferences": """SELECT t.customer_id, primary_card_type, preferred_rewards_category
        FROM primary_card_type t JOIN preferred_rewards p ON p.customer_id = t.customer_id""",
    "avg_monthly_spend": "SELECT * FROM avg_monthly_spend",
    "gold_spend_summary": "SELECT * FROM spend",
    "gold_risk_summary": "SELECT * FROM risk",
    "gold_segmentation": "SELECT * FROM segments",
    "pipeline_two_runs": "SELECT * FROM spend_2",
    "gold_spend_update": "SELECT * FROM spend_2",
    "kpi_spend": f"""SELECT round({money_sum('total_spend')} / 10000000, 6) AS total_transaction_volume_cr,
        round({money_sum('total_spend')} / count(total_spend), 6) AS average_monthly_spend,
        round({money_sum('total_refunded')} / 10000000, 6) AS total_refunded_cr,
        count(DISTINCT customer_id) AS active_customers,
        round(avg(mom_spend_change_pct) / 100, 6) AS mom_growth_rate FROM spend""",
    "kpi_monthly_trend": f"SELECT month, {money_sum('total_spend')} AS total_spend FROM spend GROUP BY month",
    "kpi_category_revenue": f"""SELECT top_merchant_category, {money_sum('total_spend')} AS total_spend
        FROM spend GROUP BY top_merchant_category""",
    "kpi_category_refunds": f"""SELECT top_merchant_category, {money_sum('total_refunded')} AS total_refunded
        FROM spend GROUP BY top_merchant_category""",
    "kpi_top10_customers": f"""SELECT customer_id, {money_sum('total_spend')} AS total_spend
        FROM spend GROUP BY customer_id ORDER BY total_spend DESC NULLS LAST, customer_id LIMIT 10""",
    "kpi_risk": f"""SELECT round({money_sum('total_credit_limit')} / 10000000, 6) AS total_credit_exposure_cr,
        CAST(sum(card_count) AS BIGINT) AS total_cards,
        CAST(sum(CASE WHEN is_high_risk_flag THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_customers,
        CAST(sum(blocked_or_lost_card_count) AS BIGINT) AS blocked_or_lost_cards,
        round(avg(credit_utilization_pct), 6) AS average_utilization_pct FROM risk""",
    "kpi_utilization_buckets": """SELECT CASE WHEN credit_utilization_pct <= 10 THEN '0-10%'
        WHEN credit_utilization_pct <= 30 THEN '10-30%' WHEN credit_utilization_pct <= 50 THEN '30-50%'
        WHEN credit_utilization_pct <= 70 THEN '50-70%' ELSE '70-100%' END AS utilization_bucket,
        count(DISTINCT customer_id) AS customers FROM risk GROUP BY 1""",
    "kpi_cards_by_status": """SELECT customer_status, CAST(sum(card_count) AS BIGINT) AS card_count FROM risk
        GROUP BY customer_status""",
    "kpi_risk_grades": _DISTRIBUTION.format(column="risk_grade", mart="risk"),
    "kpi_risk_exposure": f"""SELECT risk_grade, {money_sum('total_credit_limit')} AS total_credit_limit,
        round({money_sum('total_credit_limit')} / 10000000, 6) AS total_credit_limit_cr FROM risk GROUP BY risk_grade""",
    "kpi_segments": """SELECT round(avg(customer_tenure_months), 6) AS average_tenure_months,
        count(CASE WHEN spend_segment = 'High' THEN 1 END) / count(DISTINCT customer_id) AS premium_customer_share
        FROM segments""",
    "kpi_premium_by_income": """SELECT income_bucket, count(CASE WHEN spend_segment = 'High' THEN 1 END)
        AS premium_customers FROM segments GROUP BY income_bucket""",
    "kpi_spend_segments": """SELECT spend_segment, count(DISTINCT customer_id) AS customers FROM segments
        WHERE spend_segment IN ('Low', 'Medium', 'High', 'Very High') GROUP BY spend_segment""",
    "kpi_card_types": _DISTRIBUTION.format(column="primary_card_type", mart="segments"),
    "kpi_rewards": _DISTRIBUTION.format(column="preferred_rewards_category", mart="segments"),
    "kpi_top_reward": """SELECT preferred_rewards_category, count(DISTINCT customer_id) AS customers FROM segments
        WHERE preferred_rewards_category IS NOT NULL GROUP BY preferred_rewards_category
        ORDER BY customers DESC, preferred_rewards_category LIMIT 1""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    """Names of the expressions a text reads, those they read first."""
    for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
        if word in CTES and word not in found:
            _needed(CTES[word], found)
            found.append(word)
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, final in FINAL.items():
        parts = [f"{cte} AS ({CTES[cte]})" for cte in _needed(final, [])]
        statements[name] = f"WITH {', '.join(parts)} {final}"
    return statements
