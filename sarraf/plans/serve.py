"""Serving queries over the marts.

Lists are ordered as the dashboards show them; ``limit`` returns the first rows
only (Spark then keeps the first rows of each partition instead of sorting
everything).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from sarraf.functions import rules, text


def _listing(df: DataFrame, columns: Sequence[str], order: Sequence[Column], limit: int | None) -> DataFrame:
    # The other columns settle ties, so a limit always returns the same rows.
    shown = df.orderBy(*order, *columns).select(*columns)
    return shown if limit is None else shown.limit(limit)


def _desc(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def _mean(column: str) -> Column:
    return rules.round_to(F.avg(column), 2)


# --- terminals -----------------------------------------------------------------

def atm_performance(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "atm_id", "region", "atm_type", "provider", "capacity_tier", "is_cash_deposit_enabled",
            "transaction_date", "card_transactions", "successful_card_txns", "reversals", "deposits",
            "card_amount_mad", "avg_card_amount_mad", "ooc_events", "attempted_amount_mad", "wallet_transactions",
            "wallet_amount_mad", "success_rate_pct", "total_transactions", "total_amount_mad", "performance_grade",
        ],
        _desc("transaction_date", "total_transactions"),
        limit,
    )


def atm_by_region(mart: DataFrame) -> DataFrame:
    return mart.groupBy("region", "performance_grade").agg(
        F.count_distinct("atm_id").alias("atm_count"),
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_amount_mad").alias("total_amount_mad"),
        rules.mean_of_rounded("success_rate_pct", 2).alias("avg_success_rate_pct"),
        F.sum("ooc_events").alias("total_ooc_events"),
        F.sum("attempted_amount_mad").alias("total_lost_revenue_mad"),
    ).orderBy(*_desc("total_transactions"))


def atm_by_grade(mart: DataFrame) -> DataFrame:
    return mart.groupBy("performance_grade").agg(
        F.count_distinct("atm_id").alias("atm_count"),
        rules.mean_of_rounded("success_rate_pct", 2).alias("avg_success_rate_pct"),
        F.sum("ooc_events").alias("total_ooc_events"),
    ).orderBy("performance_grade")


def replenishment(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "atm_id", "region", "provider", "capacity_tier", "cash_limit_mad", "activity_date", "dispensed_mad",
            "card_transactions", "ooc_events", "attempted_after_empty_mad", "first_ooc_hour",
            "cash_utilization_pct", "ran_out_of_cash", "replenishment_urgency", "replenishment_status",
        ],
        [rules.urgency_rank(F.col("replenishment_urgency")).asc(), *_desc("cash_utilization_pct")],
        limit,
    )


def replenishment_by_urgency(mart: DataFrame) -> DataFrame:
    return mart.groupBy("replenishment_urgency", "replenishment_status").agg(
        F.count_distinct("atm_id").alias("atm_count"),
        F.sum("ooc_events").alias("total_ooc_events"),
        rules.mean_of_rounded("cash_utilization_pct", 2).alias("avg_utilization_pct"),
        F.sum("attempted_after_empty_mad").alias("total_lost_mad"),
    ).orderBy(*_desc("total_ooc_events"))


# --- fraud ---------------------------------------------------------------------

def fraud_risk(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "client_id", "income_segment", "credit_tier", "debt_risk_level", "age_group", "gender", "country",
            "total_transactions", "fraud_transactions", "total_amount_mad", "avg_amount_mad", "max_amount_mad",
            "fraud_rate_pct", "online_transactions", "active_days", "total_cards", "dark_web_cards",
            "expired_cards", "max_credit_limit_mad", "fraud_risk_score", "risk_level",
        ],
        _desc("fraud_risk_score"),
        limit,
    )


def fraud_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("risk_level", "income_segment", "age_group", "gender").agg(
        F.count("*").alias("customer_count"),
        rules.mean_of_rounded("fraud_risk_score", 2).alias("avg_risk_score"),
        F.sum("fraud_transactions").alias("total_fraud_txns"),
        rules.mean_of_rounded("fraud_rate_pct", 4).alias("avg_fraud_rate_pct"),
        F.sum("dark_web_cards").alias("total_dark_web_cards"),
    ).orderBy(*_desc("avg_risk_score"))


# --- channels ------------------------------------------------------------------

def channel_comparison(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "channel_code", "transaction_date", "transaction_hour", "time_of_day", "transactions",
            "total_amount_mad", "avg_amount_mad", "successful_txns", "reversals", "deposits", "success_rate_pct",
        ],
        [*_desc("transaction_date"), F.col("channel_code"), F.col("transaction_hour")],
        limit,
    )


def channel_daily(mart: DataFrame) -> DataFrame:
    total = F.sum("transactions")
    return mart.groupBy("channel_code", "transaction_date").agg(
        total.alias("total_transactions"),
        F.sum("total_amount_mad").alias("total_amount_mad"),
        _mean("avg_amount_mad").alias("avg_amount_mad"),
        F.sum("successful_txns").alias("successful_txns"),
        F.sum("reversals").alias("reversals"),
        rules.round_to(rules.ratio_pct(F.sum("successful_txns"), F.nullif(total, F.lit(0))), 2).alias("success_rate_pct"),
    ).orderBy(*_desc("transaction_date"), "channel_code")


def channel_by_time(mart: DataFrame) -> DataFrame:
    return mart.groupBy("channel_code", "time_of_day").agg(
        F.sum("transactions").alias("total_transactions"),
        rules.mean_of_rounded("success_rate_pct", 2).alias("avg_success_rate_pct"),
    ).orderBy("channel_code", "time_of_day")


# --- customers -----------------------------------------------------------------

def customer_spending(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "client_id", "income_segment", "credit_tier", "age_group", "gender", "country", "yearly_income_mad",
            "credit_score", "total_transactions", "total_spend_mad", "avg_spend_mad", "max_spend_mad",
            "morning_txns", "afternoon_txns", "evening_txns", "night_txns", "online_txns", "fraud_txns",
            "active_days", "unique_categories", "preferred_category", "spend_to_income_ratio", "online_ratio_pct",
            "activity_level",
        ],
        _desc("total_spend_mad"),
        limit,
    )


def spending_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("activity_level", "income_segment", "age_group", "preferred_category").agg(
        F.count("*").alias("customer_count"),
        _mean("total_spend_mad").alias("avg_total_spend_mad"),
        _mean("avg_spend_mad").alias("avg_transaction_mad"),
        rules.mean_of_rounded("online_ratio_pct", 2).alias("avg_online_ratio_pct"),
        rules.mean_of_rounded("spend_to_income_ratio", 2).alias("avg_spend_to_income"),
        F.sum("fraud_txns").alias("total_fraud_txns"),
    ).orderBy(*_desc("customer_count"))


def customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer


# --- regions -------------------------------------------------------------------

def governorate(mart: DataFrame, limit: int | None = None) -> DataFrame:
    return _listing(
        mart,
        [
            "region", "country", "macro_region", "population_tier", "total_atms", "atm_transactions",
            "atm_amount_mad", "successful_atm_txns", "atm_reversals", "wallet_transactions", "wallet_amount_mad",
            "successful_wallet_txns", "ooc_events", "ooc_attempted_mad", "total_transactions", "total_amount_mad",
            "atm_success_rate_pct", "ooc_rate_pct", "wallet_share_pct",
        ],
        _desc("total_transactions"),
        limit,
    )


# --- output --------------------------------------------------------------------

def json_safe(df: DataFrame) -> DataFrame:
    """NULL in place of NaN and infinities in every floating-point column."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: text.json_safe(F.col(c)) for c in floating})


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULL fields kept."""
    return json_safe(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
