"""Dashboard reports on the Gold marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.business import CRORE, utilization_bucket
from ledgerline.functions.money import as_double, total


def _sum(name: str) -> Column:
    return as_double(total(F.col(name)))


def _money_avg(name: str) -> Column:
    """Average from an exact sum, so that the result does not depend on task order."""
    return _sum(name) / F.nullif(F.count(name), F.lit(0))


def _customers_by(df: DataFrame, group: str | Column) -> DataFrame:
    return df.groupBy(group).agg(F.countDistinct("customer_id").alias("customers"))


def _is_premium() -> Column:
    """The dashboard calls the High segment premium, without Very High."""
    return F.col("spend_segment") == "High"


# -- spending ----------------------------------------------------------------------------------------------------------

def spend_headline(spend: DataFrame) -> DataFrame:
    return spend.agg(
        (_sum("total_spend") / CRORE).alias("total_transaction_volume_cr"),
        _money_avg("total_spend").alias("average_monthly_spend"),
        (_sum("total_refunded") / CRORE).alias("total_refunded_cr"),
        F.countDistinct("customer_id").alias("active_customers"),
        (F.avg("mom_spend_change_pct") / 100).alias("mom_growth_rate"),
    )


def monthly_trend(spend: DataFrame) -> DataFrame:
    return spend.groupBy("month").agg(_sum("total_spend").alias("total_spend"))


def revenue_by_category(spend: DataFrame) -> DataFrame:
    by_category = spend.groupBy("top_merchant_category").agg(_sum("total_spend").alias("total_spend"))
    return by_category.orderBy(F.desc("total_spend"), "top_merchant_category")


def refunds_by_category(spend: DataFrame) -> DataFrame:
    return spend.groupBy("top_merchant_category").agg(_sum("total_refunded").alias("total_refunded"))


def top_customers(spend: DataFrame, count: int = 10) -> DataFrame:
    by_customer = spend.groupBy("customer_id").agg(_sum("total_spend").alias("total_spend"))
    return by_customer.orderBy(F.desc_nulls_last("total_spend"), "customer_id").limit(count)


# -- risk --------------------------------------------------------------------------------------------------------------

def risk_headline(risk: DataFrame) -> DataFrame:
    return risk.agg(
        (_sum("total_credit_limit") / CRORE).alias("total_credit_exposure_cr"),
        F.sum("card_count").alias("total_cards"),
        F.count_if("is_high_risk_flag").alias("high_risk_customers"),
        F.sum("blocked_or_lost_card_count").alias("blocked_or_lost_cards"),
        F.avg("credit_utilization_pct").alias("average_utilization_pct"),
    )


def utilization_distribution(risk: DataFrame) -> DataFrame:
    return _customers_by(risk, utilization_bucket(F.col("credit_utilization_pct")).alias("utilization_bucket"))


def cards_by_customer_status(risk: DataFrame) -> DataFrame:
    return risk.groupBy("customer_status").agg(F.sum("card_count").alias("card_count"))


def risk_grade_distribution(risk: DataFrame) -> DataFrame:
    return _customers_by(risk, "risk_grade")


def exposure_by_risk_grade(risk: DataFrame) -> DataFrame:
    exposure = _sum("total_credit_limit")
    return risk.groupBy("risk_grade").agg(
        exposure.alias("total_credit_limit"), (exposure / CRORE).alias("total_credit_limit_cr")
    )


# -- segmentation ------------------------------------------------------------------------------------------------------

def segment_headline(segments: DataFrame) -> DataFrame:
    customers = F.nullif(F.countDistinct("customer_id"), F.lit(0))
    return segments.agg(
        F.avg("customer_tenure_months").alias("average_tenure_months"),
        (F.count_if(_is_premium()) / customers).alias("premium_customer_share"),
    )


def premium_by_income(segments: DataFrame) -> DataFrame:
    by_income = segments.groupBy("income_bucket").agg(F.count_if(_is_premium()).alias("premium_customers"))
    return by_income.orderBy(F.desc("premium_customers"), "income_bucket")


def spend_segment_distribution(segments: DataFrame) -> DataFrame:
    known = F.col("spend_segment").isin("Low", "Medium", "High", "Very High")
    return _customers_by(segments.where(known), "spend_segment")


def card_type_distribution(segments: DataFrame) -> DataFrame:
    return _customers_by(segments, "primary_card_type")


def rewards_preference(segments: DataFrame) -> DataFrame:
    by_reward = _customers_by(segments, "preferred_rewards_category")
    return by_reward.orderBy(F.desc("customers"), F.asc_nulls_last("preferred_rewards_category"))


def most_popular_reward(segments: DataFrame) -> DataFrame:
    named = segments.where(F.col("preferred_rewards_category").isNotNull())
    return rewards_preference(named).limit(1)
