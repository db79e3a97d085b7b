"""Histories kept of customers and cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from sarraf.operators.history import apply_snapshot, open_history

CUSTOMER_COLUMNS = [
    "client_id", "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address", "latitude",
    "longitude", "per_capita_income_mad", "yearly_income_mad", "total_debt_mad", "credit_score",
    "num_credit_cards", "age_group", "income_segment", "credit_tier", "debt_to_income_ratio", "country",
    "currency", "_silver_loaded_at",
]
CARD_COLUMNS = [
    "card_id", "client_id", "card_brand", "card_type", "card_number_masked", "has_chip", "num_cards_issued",
    "credit_limit_mad", "acct_open_date", "year_pin_last_changed", "card_on_dark_web", "expires_date",
    "is_expired", "card_age_years", "dark_web_risk", "card_category", "currency", "_silver_loaded_at",
]
LOADED_AT = "_silver_loaded_at"


def _snapshot(
    history: DataFrame | None, staged: DataFrame, key: str, columns: list[str], run_ts: Column, by_load_time: bool
) -> DataFrame:
    rows = staged.select(*columns)
    if history is None:
        return open_history(rows, key, run_ts)
    tracked = [c for c in columns if c not in (key, LOADED_AT)]
    return apply_snapshot(history, rows, key, tracked, run_ts, updated_at=LOADED_AT if by_load_time else None)


def customers_snapshot(
    history: DataFrame | None, stg_customers: DataFrame, run_ts: Column, by_load_time: bool = False
) -> DataFrame:
    """Customer history after one more load.

    Rows are compared by content.  ``by_load_time`` compares load times instead,
    which opens a new version of every row that was loaded again.
    """
    return _snapshot(history, stg_customers, "client_id", CUSTOMER_COLUMNS, run_ts, by_load_time)


def cards_snapshot(
    history: DataFrame | None, stg_cards: DataFrame, run_ts: Column, by_load_time: bool = False
) -> DataFrame:
    """Card history after one more load."""
    return _snapshot(history, stg_cards, "card_id", CARD_COLUMNS, run_ts, by_load_time)
