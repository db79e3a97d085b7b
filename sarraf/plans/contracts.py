"""Declared checks of every table (fixed values)."""

from sarraf.operators.quality import Contract

_PCT = (0, 100)
_POSITIVE = (0, None)

CONTRACTS = {
    # staging
    "stg_atm_master": Contract(
        not_null=["atm_id", "region", "cash_limit_mad"], unique=["atm_id"], ranges={"cash_limit_mad": _POSITIVE}
    ),
    "stg_atm_transactions": Contract(
        not_null=["refnum", "atm_id", "amount_mad", "is_successful", "transaction_date"], unique=["refnum"],
        ranges={"amount_mad": _POSITIVE},
    ),
    "stg_card_transactions": Contract(
        not_null=["refnum", "client_id", "amount_mad", "transaction_date"], unique=["refnum"],
        ranges={"amount_mad": _POSITIVE},
    ),
    "stg_cards": Contract(
        not_null=["card_id", "client_id"], unique=["card_id"], values={"dark_web_risk": ["LOW", "HIGH"]}
    ),
    "stg_customers": Contract(
        not_null=["client_id", "credit_score", "country"], unique=["client_id"],
        values={"gender": ["M", "F", "MALE", "FEMALE", "OTHER"]}, ranges={"credit_score": (300, 850)},
    ),
    "stg_out_of_cash": Contract(
        not_null=["refnum", "atm_id", "attempted_amount_mad", "is_confirmed_ooc"],
        ranges={"attempted_amount_mad": _POSITIVE},
    ),
    "stg_transactions": Contract(
        not_null=["transaction_id", "client_id", "card_id", "amount_mad", "is_fraud", "transaction_date"],
        unique=["transaction_id"],
    ),
    "stg_wallet_transactions": Contract(
        not_null=["transaction_id", "amount_mad", "is_successful", "transaction_date"], unique=["transaction_id"],
        ranges={"amount_mad": _POSITIVE},
    ),
    # dimensions
    "dim_customer": Contract(
        not_null=["customer_key", "client_id", "credit_score"], unique=["customer_key", "client_id"],
        values={
            "debt_risk_level": ["LOW_RISK", "MEDIUM_RISK", "HIGH_RISK"],
            "credit_usage_tier": ["LIGHT_USER", "MODERATE_USER", "HEAVY_USER"],
        },
        ranges={"credit_score": (300, 850)},
    ),
    "dim_card": Contract(
        not_null=["card_key", "card_id", "client_id", "customer_key"], unique=["card_key", "card_id"],
        values={
            "dark_web_risk": ["LOW", "HIGH"],
            "card_risk_level": ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
        },
    ),
    "dim_atm": Contract(
        not_null=["atm_key", "atm_id", "cash_limit_mad"], unique=["atm_key", "atm_id"],
        values={
            "capacity_tier": ["LOW_CAPACITY", "MEDIUM_CAPACITY", "HIGH_CAPACITY"],
            "atm_maturity": ["NEW", "ESTABLISHED", "MATURE"],
        },
        ranges={"cash_limit_mad": _POSITIVE},
    ),
    "dim_date": Contract(
        not_null=["date_key", "full_date", "year", "month"], unique=["date_key", "full_date"],
        ranges={"month": (1, 12)},
    ),
    "dim_geography": Contract(
        not_null=["geography_key", "region", "country"], unique=["geography_key"],
        values={
            "macro_region": ["NORTH", "SOUTH", "EAST", "OTHER"],
            "population_tier": ["TIER_1", "TIER_2", "TIER_3"],
        },
    ),
    "dim_merchant": Contract(
        not_null=["merchant_key", "merchant_id", "mcc_code"], unique=["merchant_key", "merchant_id"]
    ),
    "dim_merchant_category": Contract(
        not_null=["merchant_category_key", "mcc_code", "category_group"],
        unique=["merchant_category_key", "mcc_code"],
    ),
    "dim_pan_customer_map": Contract(
        not_null=["pan_key", "pan_masked", "client_id", "customer_key"], unique=["pan_key"]
    ),
    # facts
    "fact_atm_transactions": Contract(
        not_null=[
            "atm_transaction_key", "refnum", "atm_key", "date_key", "amount_mad", "is_successful", "is_reversal",
            "is_deposit", "is_out_of_cash", "transaction_date",
        ],
        unique=["atm_transaction_key"], ranges={"amount_mad": _POSITIVE},
    ),
    "fact_card_transactions": Contract(
        not_null=[
            "card_transaction_key", "transaction_id", "customer_key", "card_key", "date_key", "amount_mad",
            "is_fraud", "transaction_date",
        ],
        unique=["card_transaction_key"], values={"is_fraud": [True, False]}, ranges={"amount_abs": _POSITIVE},
    ),
    "fact_wallet_transactions": Contract(
        not_null=[
            "wallet_transaction_key", "transaction_id", "date_key", "amount_mad", "is_successful",
            "transaction_date",
        ],
        unique=["wallet_transaction_key"], ranges={"amount_mad": _POSITIVE},
    ),
    "fact_out_of_cash_events": Contract(
        not_null=[
            "out_of_cash_key", "refnum", "atm_key", "date_key", "attempted_amount_mad", "is_confirmed_ooc",
            "transaction_date",
        ],
        unique=["out_of_cash_key"], ranges={"attempted_amount_mad": _POSITIVE},
    ),
    # marts
    "atm_performance": Contract(
        not_null=["atm_key", "atm_id", "performance_grade"],
        values={
            "performance_grade": ["A", "B", "C", "D"],
            "capacity_tier": ["LOW_CAPACITY", "MEDIUM_CAPACITY", "HIGH_CAPACITY"],
        },
        ranges={"success_rate_pct": _PCT},
    ),
    "fraud_risk_scoring": Contract(
        not_null=["customer_key", "client_id", "fraud_risk_score", "risk_level"],
        unique=["customer_key", "client_id"], values={"risk_level": ["LOW", "MEDIUM", "HIGH", "CRITICAL"]},
        ranges={"fraud_risk_score": _PCT, "fraud_rate_pct": _PCT},
    ),
    "customer_spending_behavior": Contract(
        not_null=["customer_key", "client_id", "activity_level"], unique=["customer_key", "client_id"],
        values={"activity_level": ["INACTIVE", "RARE", "OCCASIONAL", "ACTIVE", "VERY_ACTIVE"]},
        ranges={"total_spend_mad": _POSITIVE, "online_ratio_pct": _PCT},
    ),
    "replenishment_analysis": Contract(
        not_null=["atm_key", "replenishment_urgency", "replenishment_status"],
        values={
            "replenishment_urgency": ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
            "replenishment_status": ["OK", "SOON", "URGENT"],
        },
        ranges={"cash_utilization_pct": _POSITIVE},
    ),
    "channel_comparison": Contract(
        not_null=["channel_key", "channel_code", "transaction_date", "time_of_day"],
        values={"time_of_day": ["MORNING", "AFTERNOON", "EVENING", "NIGHT"]}, ranges={"success_rate_pct": _PCT},
    ),
    "governorate_summary": Contract(
        not_null=["region", "country", "macro_region"], unique=["region"],
        values={"macro_region": ["NORTH", "SOUTH", "EAST", "OTHER"]},
        ranges={"total_atms": _POSITIVE, "atm_success_rate_pct": _PCT},
    ),
}
