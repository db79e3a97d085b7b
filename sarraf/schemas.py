"""Shapes of the landed tables, for readers that must not infer them.

Types are those of the sources; the silver layer decides the final ones.
"""

RAW_SCHEMAS = {
    "raw_atm_master": (
        "terminal_id string, governorate string, type string, replenished_by string, replenished_from string, "
        "installation_date string, limits bigint"
    ),
    "raw_customers": (
        "id bigint, current_age bigint, retirement_age int, birth_year bigint, birth_month bigint, gender string, "
        "address string, latitude double, longitude double, per_capita_income string, yearly_income string, "
        "total_debt string, credit_score bigint, num_credit_cards bigint"
    ),
    "raw_cards": (
        "id bigint, client_id bigint, card_brand string, card_type string, card_number string, cvv string, "
        "has_chip string, num_cards_issued int, credit_limit string, acct_open_date string, "
        "year_pin_last_changed int, expires string, card_on_dark_web string"
    ),
    "raw_card_transactions": (
        "refnum string, pan string, termid string, date string, time string, descr string, msgtype int, "
        "amount double, respcode int"
    ),
    "raw_wallet_transactions": (
        "transaction_id string, mobile_number string, term_id string, transaction_date timestamp, "
        "transaction_type string, transaction_amount double, transaction_status string"
    ),
    "raw_out_of_cash": (
        "pan string, refnum string, termid string, date string, time string, amount string, respcode int, "
        "descr string"
    ),
    "raw_kaggle_transactions": (
        "id string, client_id bigint, card_id bigint, date string, amount string, use_chip string, "
        "merchant_id bigint, merchant_city string, merchant_state string, zip string, mcc string, errors string"
    ),
}

RAW_SCHEMAS["raw_fraud_labels"] = "transaction_id string, label string"

# The column whose day bronze is divided by, for tables that grow with time.
EVENT_TIME = {
    "raw_card_transactions": "date",
    "raw_wallet_transactions": "transaction_date",
    "raw_out_of_cash": "date",
    "raw_kaggle_transactions": "date",
}

# Columns that landing adds to every row, and their bronze names.
LANDED_COLUMNS = "_batch_id string, _batch_num int, _ingested_at timestamp, _source_table string"
BATCH_COLUMNS = "batch_id string, batch_num int, ingested_at timestamp, source_table string"
