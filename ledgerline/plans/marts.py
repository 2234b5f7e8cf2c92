"""Silver to Gold: the three business marts and the aggregates they are made of.

Silver rows always have their key, so rows are counted without reading the key columns, which are the widest ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.business import (
    HIGH_UTILIZATION_PCT,
    is_refund,
    is_spend,
    month_of,
    percent_change,
    spend_segment,
    tenure_months,
)
from ledgerline.functions.money import as_double, money, total
from ledgerline.operators.ranking import best

# States that count against a card or a customer.
TROUBLED_CARD = ("Blocked", "Lost")
TROUBLED_CUSTOMER = ("Blocked", "Dormant")

CUSTOMER_MONTH = ("customer_id", "month")


# -- spend -------------------------------------------------------------------------------------------------------------

def successful_with_category(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Successful transactions with their month and merchant category.

    No broadcast hint: Spark broadcasts the two merchant columns when they are below its threshold and otherwise
    shuffles, AQE splitting the partition of a merchant that holds very many transactions.
    """
    wanted = transactions.where(F.col("transaction_status") == "Successful").select(
        "transaction_id", "customer_id", "merchant_id", "amount", "transaction_type",
        month_of(F.col("transaction_timestamp")).alias("month"),
    )
    return wanted.join(merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")


def _spending(transactions: DataFrame) -> DataFrame:
    return transactions.where(is_spend(F.col("transaction_type")))


def monthly_spend(transactions: DataFrame) -> DataFrame:
    sums = _spending(transactions).groupBy(*CUSTOMER_MONTH).agg(
        total(F.col("amount")).alias("spend"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.count("amount").alias("amounts"),
    )
    return sums.select(
        *CUSTOMER_MONTH,
        as_double(F.col("spend")).alias("total_spend"),
        "transaction_count",
        (as_double(F.col("spend")) / F.col("amounts")).alias("avg_transaction_amount"),
    )


def monthly_refunds(transactions: DataFrame) -> DataFrame:
    refunds = transactions.where(is_refund(F.col("transaction_type")))
    return refunds.groupBy(*CUSTOMER_MONTH).agg(
        as_double(total(F.abs(F.col("amount")))).alias("total_refunded")
    )


def category_spend(transactions: DataFrame) -> DataFrame:
    return _spending(transactions).groupBy(*CUSTOMER_MONTH, "merchant_category").agg(
        as_double(total(F.col("amount"))).alias("category_spend")
    )


def top_category(by_category: DataFrame) -> DataFrame:
    return by_category.groupBy(*CUSTOMER_MONTH).agg(
        best(F.col("merchant_category"), F.col("category_spend")).alias("top_merchant_category")
    )


def with_month_over_month(monthly: DataFrame) -> DataFrame:
    """Against the customer's previous month with spend, which need not be the previous calendar month."""
    by_month = Window.partitionBy("customer_id").orderBy("month")
    previous = monthly.withColumn("prev_month_spend", F.lag("total_spend").over(by_month))
    return previous.withColumn(
        "mom_spend_change_pct", percent_change(F.col("total_spend"), F.col("prev_month_spend"))
    )


def with_anomaly_flag(monthly: DataFrame) -> DataFrame:
    """A month is anomalous when it exceeds twice the average of the three rows before it."""
    before = Window.partitionBy("customer_id").orderBy("month").rowsBetween(-3, -1)
    trailing = monthly.withColumn("trailing_3mo_avg_spend", F.avg("total_spend").over(before))
    unusual = F.col("total_spend") > 2 * F.col("trailing_3mo_avg_spend")
    return trailing.withColumn("is_anomalous_spend", F.coalesce(unusual, F.lit(False)))


def spend_summary(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row per customer and month with spend.

    The transactions are read and shuffled once: one aggregate per customer, month and category (combined before the
    shuffle, so a customer or merchant with very many rows is spread out) yields spend, refunds and the category
    ranking. Its small result moves once more, by customer, and serves the monthly roll-up and both windows in place.
    A customer then has at most months x categories rows.
    """
    kind = F.col("transaction_type")
    facts = transactions.where(
        (F.col("transaction_status") == "Successful") & (is_spend(kind) | is_refund(kind))
    ).select(
        "customer_id", "merchant_id", month_of(F.col("transaction_timestamp")).alias("month"),
        money(F.col("amount")).alias("amount"), is_spend(kind).alias("spent"),
    )
    enriched = facts.join(merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")
    amount, spent = F.col("amount"), F.col("spent")
    by_category = enriched.groupBy(*CUSTOMER_MONTH, "merchant_category").agg(
        F.sum(F.when(spent, amount)).alias("spend"),
        F.count_if(spent).alias("spend_count"),
        F.count(F.when(spent, amount)).alias("spend_amounts"),
        F.sum(F.when(~spent, F.abs(amount))).alias("refunded"),
    )
    monthly = by_category.repartition("customer_id").groupBy(*CUSTOMER_MONTH).agg(
        F.sum("spend").alias("spend"),
        F.sum("spend_count").alias("transaction_count"),
        F.sum("spend_amounts").alias("spend_amounts"),
        F.sum("refunded").alias("refunded"),
        best(F.col("merchant_category"), F.col("spend"), F.col("spend_count") > 0).alias("top_merchant_category"),
    )
    # months with refunds only have no spend row
    spent = monthly.where(F.col("transaction_count") > 0).select(
        *CUSTOMER_MONTH,
        as_double(F.col("spend")).alias("total_spend"),
        "transaction_count",
        (as_double(F.col("spend")) / F.col("spend_amounts")).alias("avg_transaction_amount"),
        F.coalesce(as_double(F.col("refunded")), F.lit(0.0)).alias("total_refunded"),
        "top_merchant_category",
    )
    return with_anomaly_flag(with_month_over_month(spent))


# -- risk --------------------------------------------------------------------------------------------------------------

def card_rollup(cards: DataFrame) -> DataFrame:
    return cards.groupBy(F.col("card_holder_id").alias("customer_id")).agg(
        as_double(total(F.col("credit_limit"))).alias("total_credit_limit"),
        F.count(F.lit(1)).alias("card_count"),
        F.count_if(F.col("card_status").isin(*TROUBLED_CARD)).alias("blocked_or_lost_card_count"),
    )


def current_month_spend(spend: DataFrame) -> DataFrame:
    """Spend of each customer's latest month."""
    return spend.groupBy("customer_id").agg(F.max_by("total_spend", "month").alias("current_month_spend"))


def risk_summary(customers: DataFrame, cards: DataFrame, spend: DataFrame) -> DataFrame:
    """One row per current customer. Both roll-ups are combined before their shuffle; all joins use the customer id."""
    joined = (
        customers.where(F.col("is_current")).select("customer_id", "risk_grade", "customer_status")
        .join(card_rollup(cards), "customer_id", "left")
        .join(current_month_spend(spend), "customer_id", "left")
    )
    filled = joined.select(
        "customer_id", "risk_grade", "customer_status",
        F.coalesce("total_credit_limit", F.lit(0.0)).alias("total_credit_limit"),
        F.coalesce("card_count", F.lit(0).cast("long")).alias("card_count"),
        F.coalesce("blocked_or_lost_card_count", F.lit(0).cast("long")).alias("blocked_or_lost_card_count"),
        F.coalesce("current_month_spend", F.lit(0.0)).alias("current_month_spend"),
    )
    limit = F.col("total_credit_limit")
    utilization = F.when(limit > 0, F.col("current_month_spend") / limit * 100).otherwise(0.0)
    # NULL when the grade or status is unknown and nothing else marks the customer
    high_risk = (
        (F.col("risk_grade") == "High")
        | F.col("customer_status").isin(*TROUBLED_CUSTOMER)
        | (F.col("credit_utilization_pct") > HIGH_UTILIZATION_PCT)
    )
    return filled.withColumn("credit_utilization_pct", utilization).withColumn("is_high_risk_flag", high_risk)


# -- segmentation ------------------------------------------------------------------------------------------------------

def most_common(cards: DataFrame, column: str, alias: str) -> DataFrame:
    """Each holder's most frequent value of a card column."""
    counts = cards.groupBy("card_holder_id", column).agg(F.count(F.lit(1)).alias("cards"))
    return counts.groupBy(F.col("card_holder_id").alias("customer_id")).agg(
        best(F.col(column), F.col("cards")).alias(alias)
    )


def card_preferences(cards: DataFrame) -> DataFrame:
    """Most frequent holder type and rewards category of each holder from one scan of the cards.

    Cards are counted per holder, type and category first (combined before the shuffle), so a holder with very many
    cards shrinks to types x categories rows. Those move by holder once; the rest runs in place.
    """
    kind, reward = "card_holder_type", "card_rewards_category"
    counts = cards.groupBy("card_holder_id", kind, reward).agg(F.count(F.lit(1)).alias("cards"))
    local = counts.repartition("card_holder_id")

    def cards_per(column: str) -> Column:
        return F.sum("cards").over(Window.partitionBy("card_holder_id", column))

    scored = local.withColumn("of_kind", cards_per(kind)).withColumn("of_reward", cards_per(reward))
    return scored.groupBy(F.col("card_holder_id").alias("customer_id")).agg(
        best(F.col(kind), F.col("of_kind")).alias("primary_card_type"),
        best(F.col(reward), F.col("of_reward")).alias("preferred_rewards_category"),
    )


def avg_monthly_spend(spend: DataFrame) -> DataFrame:
    sums = spend.groupBy("customer_id").agg(
        total(F.col("total_spend")).alias("spend"), F.count("total_spend").alias("months")
    )
    return sums.select("customer_id", (as_double(F.col("spend")) / F.col("months")).alias("avg_monthly_spend"))


def segmentation_summary(
    customers: DataFrame, cards: DataFrame, spend: DataFrame, as_of: Column | None = None
) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    profiles = customers.where(F.col("is_current")).select(
        "customer_id", "customer_city", "occupation", "income_bucket", "joining_date",
        tenure_months(today, F.col("joining_date")).alias("customer_tenure_months"),
    )
    joined = profiles.join(card_preferences(cards), "customer_id", "left").join(
        avg_monthly_spend(spend), "customer_id", "left"
    )
    return joined.withColumn("spend_segment", spend_segment(F.col("avg_monthly_spend")))
