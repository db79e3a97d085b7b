"""Staging: silver under the names the marts use, with defaults for missing flags.

Every function takes a silver table and ``keyed``.  A silver table may hold
several loads of a key, so the latest load is kept; a table that is known to
hold each key once (one written by the keyed merge, or a fresh silver plan) is
passed with ``keyed=True``, which saves a shuffle of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions import fixed_values as fv
from sarraf.operators.dedup import latest_per_key

LOADED_AT = "_silver_loaded_at"


def _latest(df: DataFrame, key: str, keyed: bool) -> DataFrame:
    return df if keyed else latest_per_key(df, key, LOADED_AT)


def _or_false(column: str) -> Column:
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False)).alias(column)


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


def _trimmed(column: str, name: str | None = None) -> Column:
    return F.trim(column).alias(name or column)


def _shouted(column: str, name: str | None = None) -> Column:
    return F.upper(F.trim(column)).alias(name or column)


def _as(kind: str, *columns: str) -> list[Column]:
    return [F.col(c).cast(kind).alias(c) for c in columns]


def _attempt(kind: str, *columns: str) -> list[Column]:
    return [F.col(c).try_cast(kind).alias(c) for c in columns]


def stg_atm_master(silver: DataFrame, keyed: bool = False) -> DataFrame:
    staged = silver.filter(F.col("terminal_id").isNotNull()).select(
        F.col("terminal_id").alias("atm_id"),
        "region", "atm_type", "provider", "location_type", "installation_date",
        F.col("cash_limit").cast("double").alias("cash_limit_mad"),
        "is_cash_deposit_enabled", "atm_age_years", "country", "bank_name", "currency", LOADED_AT,
    )
    return _latest(staged, "atm_id", keyed)


def stg_customers(silver: DataFrame, keyed: bool = False) -> DataFrame:
    staged = silver.filter(F.col("client_id").isNotNull()).select(
        *_as("string", "client_id"),
        *_as("int", "current_age", "retirement_age", "birth_year", "birth_month"),
        _shouted("gender"), _trimmed("address"),
        *_as("double", "latitude", "longitude"),
        *[F.col(c).cast("double").alias(f"{c}_mad") for c in ("per_capita_income", "yearly_income", "total_debt")],
        *_as("int", "credit_score", "num_credit_cards"),
        _trimmed("age_group"), _trimmed("income_segment"), _trimmed("credit_tier"),
        *_as("double", "debt_to_income_ratio"),
        _or("country", fv.COUNTRY), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "client_id", keyed)


def stg_cards(silver: DataFrame, keyed: bool = False) -> DataFrame:
    staged = silver.filter(F.col("card_id").isNotNull() & F.col("client_id").isNotNull()).select(
        *_as("string", "card_id", "client_id"),
        _shouted("card_brand"), _shouted("card_type"), _trimmed("card_number_masked"),
        _or_false("has_chip"), _or("num_cards_issued", 1),
        F.col("credit_limit").cast("double").alias("credit_limit_mad"),
        *_attempt("date", "acct_open_date"), *_as("int", "year_pin_last_changed"),
        _or_false("card_on_dark_web"), *_attempt("date", "expires_date"),
        _or_false("is_expired"), _or("card_age_years", 0),
        _trimmed("dark_web_risk"), _trimmed("card_category"), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "card_id", keyed)


def stg_atm_transactions(silver: DataFrame, keyed: bool = False) -> DataFrame:
    """Terminal transactions; flags stay NULL where silver has none."""
    staged = silver.filter(F.col("refnum").isNotNull() & (F.col("amount_mad").cast("double") >= 0)).select(
        "refnum", F.col("terminal_id").alias("atm_id"),
        *_as("double", "amount_mad"), *_as("date", "transaction_date"), *_as("int", "transaction_hour"),
        "transaction_type", *_as("int", "msg_type", "resp_code"),
        *_as("boolean", "is_successful", "is_reversal", "is_out_of_cash", "is_deposit"),
        *_as("string", "client_id"), "channel", "currency", LOADED_AT,
    )
    return _latest(staged, "refnum", keyed)


def stg_card_transactions(silver: DataFrame, keyed: bool = False) -> DataFrame:
    """The same transactions for card use: flags default to FALSE, the channel to the terminal's."""
    staged = silver.filter(F.col("refnum").isNotNull() & (F.col("amount_mad").cast("double") >= 0)).select(
        *_as("string", "refnum", "terminal_id", "client_id"),
        *_attempt("date", "transaction_date"), *_as("int", "transaction_hour"),
        _trimmed("transaction_type"), *_as("int", "msg_type"), *_as("double", "amount_mad"), *_as("int", "resp_code"),
        *[_or_false(c) for c in ("is_successful", "is_reversal", "is_out_of_cash", "is_deposit")],
        F.coalesce(F.trim("channel"), F.lit(fv.CHANNEL_ATM)).alias("channel"), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "refnum", keyed)


def stg_wallet_transactions(silver: DataFrame, keyed: bool = False) -> DataFrame:
    staged = silver.filter(F.col("transaction_id").isNotNull() & (F.col("amount_mad") >= 0)).select(
        _trimmed("transaction_id"), _trimmed("mobile_number_masked"), _shouted("terminal_id", "atm_id"),
        *_attempt("timestamp", "transaction_datetime"), *_attempt("date", "transaction_date"),
        *_as("int", "transaction_hour"), _trimmed("transaction_type"), *_as("double", "amount_mad"),
        _trimmed("transaction_status"),
        *[_or_false(c) for c in ("is_reversal", "is_cash_out", "is_successful")],
        _or("channel", fv.CHANNEL_WALLET), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "transaction_id", keyed)


def stg_out_of_cash(silver: DataFrame, keyed: bool = False) -> DataFrame:
    staged = silver.filter(F.col("terminal_id").isNotNull() & F.col("refnum").isNotNull()).select(
        _trimmed("refnum"), _trimmed("pan", "pan_masked"), _shouted("terminal_id", "atm_id"),
        *_attempt("date", "transaction_date"), *_as("int", "transaction_hour"),
        *_as("double", "attempted_amount_mad"), *_as("int", "resp_code"),
        F.coalesce(F.trim("failure_reason"), F.lit(fv.EMPTY_ATM_REASON)).alias("failure_reason"),
        _or_false("is_confirmed_ooc"), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "refnum", keyed)


def stg_transactions(silver: DataFrame, keyed: bool = False) -> DataFrame:
    """Purchases with the fraud flag."""
    staged = silver.filter(F.col("transaction_id").isNotNull() & F.col("client_id").isNotNull()).select(
        *_as("string", "transaction_id", "client_id", "card_id"),
        *_attempt("timestamp", "transaction_datetime"), *_attempt("date", "transaction_date"),
        *_as("int", "transaction_hour"), *_as("double", "amount_mad", "amount_abs"),
        _or_false("is_negative_amount"), _trimmed("use_chip"), *_as("string", "merchant_id"),
        _trimmed("merchant_city"), _trimmed("merchant_region"), *_as("string", "zip", "mcc", "errors"),
        _or_false("is_online"), _or_false("is_chip_transaction"), _trimmed("amount_bucket"), _trimmed("channel"),
        _or_false("is_fraud"), _or("country", fv.COUNTRY), _or("currency", fv.CURRENCY), LOADED_AT,
    )
    return _latest(staged, "transaction_id", keyed)
