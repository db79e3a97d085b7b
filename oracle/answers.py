"""Expected answer per query.  Dates and timestamps are compared as text."""

from __future__ import annotations

from oracle.tables import with_tables
from sarraf.plans.contracts import CONTRACTS

RUN_TS = "'2024-06-01 00:00:00.000000'"


def _day(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


def _all_of(table: str, days: tuple[str, ...] = (), stamps: tuple[str, ...] = (), bigints: tuple[str, ...] = ()) -> str:
    changed = [_day(c) for c in days] + [_stamp(c) for c in stamps] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    replace = f" REPLACE ({', '.join(changed)})" if changed else ""
    return f"SELECT *{replace} FROM {table}"


def _mean(column: str, digits: int = 2) -> str:
    """Mean of values rounded to ``digits``, in whole units of the last digit (free of summation order)."""
    scale = 10**digits
    return f"round(CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS DOUBLE) / count({column})) / {scale}"


ANSWERS: dict[str, str] = {}


def _answer(key: str, sql: str) -> None:
    ANSWERS[key] = with_tables(sql)


# --- sources and columns ---------------------------------------------------------

_answer("bronze_ingest", f"""
SELECT * REPLACE ({_stamp('o_orderdate')}, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority),
       CASE WHEN o_orderstatus = 'O' THEN 'web' END AS order_channel, 'orders' AS source_table, o_orderstatus AS batch_id,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS batch_num,
       printf('orders_%06d_%s', CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderstatus) AS source_folder
FROM orders
""")
for _key in ("fraud_labels_explode", "fraud_labels_object"):
    _answer(_key, """
SELECT transaction_id, upper(trim(label)) IN ('YES', 'OUI', 'TRUE', '1') AS is_fraud FROM raw_fraud_labels
""")
_answer("seed_dims", """
SELECT 'channel' AS seed, c.channel_key AS seed_key, c.channel_code AS code, c.channel_name AS label,
       coalesce(n.n, 0) AS n_transactions
FROM dim_channel c LEFT JOIN (
    SELECT channel, count(*) AS n FROM (SELECT channel FROM silver_card_transactions UNION ALL
        SELECT channel FROM silver_wallet UNION ALL SELECT channel FROM silver_kaggle) GROUP BY channel) n
  ON c.channel_code = n.channel
UNION ALL
SELECT 'error_type', e.error_type_key, CAST(e.error_code AS VARCHAR), e.error_description, coalesce(n.n, 0)
FROM dim_error_type e LEFT JOIN (SELECT resp_code, count(*) AS n FROM silver_card_transactions GROUP BY resp_code) n
  ON e.error_code = n.resp_code
""")
_answer("run_results_flatten", """
SELECT CAST(l_orderkey AS VARCHAR) AS node_id, 'bank' AS node_name, 'model' AS type, l_linestatus AS status,
       l_quantity / 4 AS duration, CAST(0 AS BIGINT) AS failures, '' AS message FROM lineitem
UNION ALL
SELECT CAST(l_linenumber AS VARCHAR), 'not_null_' || l_partkey, 'test', l_returnflag, 0.25, l_suppkey, 'checked'
FROM lineitem
UNION ALL
SELECT 'seed_' || l_returnflag, 'seed_' || l_returnflag, 'unknown', l_linestatus, 0.0, 0, '' FROM lineitem
""")
_answer("run_results_by_status", """
SELECT type, status, count(*) AS nodes, CAST(sum(failures) AS BIGINT) AS failures, sum(duration) AS duration FROM (
    SELECT 'model' AS type, l_linestatus AS status, 0 AS failures, l_quantity / 4 AS duration FROM lineitem
    UNION ALL SELECT 'test', l_returnflag, l_suppkey, 0.25 FROM lineitem
    UNION ALL SELECT 'unknown', l_linestatus, 0, 0 FROM lineitem) GROUP BY type, status
""")
_answer("conform_atm_master", """
SELECT terminal_id, governorate AS region, type AS atm_type, replenished_by AS provider,
       replenished_from AS location_type, installation_date, limits AS cash_limit FROM raw_atm_master
""")
_answer("error_code_clean", """
SELECT id AS transaction_id, errors, TRY_CAST(nullif(trim(errors), 'NaN') AS INTEGER) AS error_code_clean
FROM raw_kaggle_transactions
""")
_answer("convert_to_mad", """
SELECT refnum, date, currency, round(amount * CASE currency WHEN 'MAD' THEN 1.0 WHEN 'USD' THEN 10.0 WHEN 'EUR' THEN 10.9
           WHEN 'GBP' THEN 12.7 WHEN 'AED' THEN 2.72 WHEN 'SAR' THEN 2.67 ELSE 1.0 END, 2) AS amount_mad,
       round(amount * 10.9, 2) AS amount_mad_if_eur
FROM (SELECT refnum, date, amount,
             ['MAD', 'USD', 'EUR', 'GBP', 'AED', 'SAR', 'XXX'][1 + CAST(substr(time, 1, 2) AS INTEGER) % 7] AS currency
      FROM raw_card_transactions)
""")
_answer("json_safe", """
SELECT c_custkey, CASE WHEN c_nationkey % 5 < 3 THEN NULL ELSE c_acctbal END AS balance FROM customer
""")
_answer("classify_risk_level", """
SELECT client_id, CASE WHEN dark_web_cards > 0 THEN 'CRITICAL' WHEN fraud_rate_pct > 10 THEN 'HIGH'
       WHEN fraud_rate_pct > 5 OR debt_risk_level = 'HIGH_RISK' THEN 'MEDIUM' ELSE 'LOW' END AS risk_class
FROM fraud_risk_scoring
""")
_answer("classify_risk_score", """
SELECT client_id, CASE WHEN fraud_risk_score >= 75 THEN 'CRITICAL' WHEN fraud_risk_score >= 50 THEN 'HIGH'
       WHEN fraud_risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS score_class
FROM fraud_risk_scoring
""")

# --- silver, staging, dimensions, facts ------------------------------------------

_answer("silver_atm_master", _all_of("silver_atm_master", ("installation_date",)))
_answer("silver_customers", _all_of("silver_customers"))
_answer("silver_cards", _all_of("silver_cards", ("acct_open_date", "expires_date")))
_answer("silver_card_transactions", _all_of("silver_card_transactions", ("transaction_date",)))
_answer("silver_wallet", _all_of("silver_wallet", ("transaction_date",), ("transaction_datetime",)))
_answer("silver_out_of_cash", _all_of("silver_out_of_cash", ("transaction_date",)))
_answer("silver_kaggle", _all_of("silver_kaggle", ("transaction_date",), ("transaction_datetime",)))
_answer("pan_customer_map_silver", _all_of("pan_customer_map_silver"))

_answer("stg_atm_master", _all_of("stg_atm_master", ("installation_date",)))
_answer("stg_customers", _all_of("stg_customers"))
_answer("stg_cards", _all_of("stg_cards", ("acct_open_date", "expires_date")))
_answer("stg_atm_transactions", _all_of("stg_atm_transactions", ("transaction_date",)))
_answer("stg_card_transactions", _all_of("stg_card_transactions", ("transaction_date",)))
_answer("stg_wallet_transactions", _all_of("stg_wallet_transactions", ("transaction_date",), ("transaction_datetime",)))
_answer("stg_out_of_cash", _all_of("stg_out_of_cash", ("transaction_date",)))
_answer("stg_transactions", _all_of("stg_transactions", ("transaction_date",), ("transaction_datetime",)))

_answer("dim_atm", _all_of("dim_atm", ("installation_date",)))
_answer("dim_customer", _all_of("dim_customer"))
_answer("dim_card", _all_of("dim_card", ("acct_open_date", "expires_date")))
_answer("dim_date", """
SELECT d.* REPLACE (CAST(full_date AS VARCHAR) AS full_date), coalesce(p.n, 0) AS purchases,
       coalesce(a.n, 0) AS atm_transactions
FROM dim_date d
LEFT JOIN (SELECT transaction_date, count(*) AS n FROM fact_card_transactions GROUP BY ALL) p
  ON d.full_date = p.transaction_date
LEFT JOIN (SELECT transaction_date, count(*) AS n FROM fact_atm_transactions GROUP BY ALL) a
  ON d.full_date = a.transaction_date
""")
_answer("dim_geography", _all_of("dim_geography"))
_answer("dim_geography_literal",
        "SELECT * REPLACE (TRUE AS is_atm_location, TRUE AS is_merchant_location) FROM dim_geography")
_answer("dim_merchant", _all_of("dim_merchant"))
_answer("dim_merchant_category", _all_of("dim_merchant_category"))
_answer("dim_pan_customer_map", _all_of("dim_pan_customer_map"))
_answer("primary_card", _all_of("primary_card"))
_answer("top_category", _all_of("top_category"))

for _fact in ("fact_atm_transactions", "fact_card_transactions", "fact_wallet_transactions", "fact_out_of_cash_events"):
    _answer(_fact, _all_of(_fact, ("transaction_date",)))

# --- marts -----------------------------------------------------------------------

for _mart in ("atm_performance", "atm_performance_full_calendar", "channel_comparison", "channel_comparison_literal"):
    _answer(_mart, _all_of(_mart, ("transaction_date",)))
_answer("replenishment_analysis", _all_of("replenishment_analysis", ("activity_date",)))
for _mart in ("customer_spending_behavior", "customer_spending_behavior_literal", "fraud_risk_scoring",
              "governorate_summary"):
    _answer(_mart, _all_of(_mart))

# --- serving ---------------------------------------------------------------------

_answer("serve_atm_performance", """
SELECT atm_id, region, atm_type, provider, capacity_tier, is_cash_deposit_enabled,
       CAST(transaction_date AS VARCHAR) AS transaction_date, card_transactions, successful_card_txns, reversals,
       deposits, card_amount_mad, avg_card_amount_mad, ooc_events, attempted_amount_mad, wallet_transactions,
       wallet_amount_mad, success_rate_pct, total_transactions, total_amount_mad, performance_grade
FROM atm_performance
""")
_answer("serve_atm_by_region", f"""
SELECT region, performance_grade, count(DISTINCT atm_id) AS atm_count,
       CAST(sum(total_transactions) AS BIGINT) AS total_transactions, sum(total_amount_mad) AS total_amount_mad,
       {_mean('success_rate_pct')} AS avg_success_rate_pct, CAST(sum(ooc_events) AS BIGINT) AS total_ooc_events,
       sum(attempted_amount_mad) AS total_lost_revenue_mad
FROM atm_performance GROUP BY region, performance_grade
""")
_answer("serve_atm_by_grade", f"""
SELECT performance_grade, count(DISTINCT atm_id) AS atm_count,
       {_mean('success_rate_pct')} AS avg_success_rate_pct, CAST(sum(ooc_events) AS BIGINT) AS total_ooc_events
FROM atm_performance GROUP BY performance_grade
""")
_answer("serve_replenishment", """
SELECT atm_id, region, provider, capacity_tier, cash_limit_mad, CAST(activity_date AS VARCHAR) AS activity_date,
       dispensed_mad, card_transactions, ooc_events, attempted_after_empty_mad, first_ooc_hour, cash_utilization_pct,
       ran_out_of_cash, replenishment_urgency, replenishment_status
FROM replenishment_analysis
""")
_answer("serve_replenishment_by_urgency", f"""
SELECT replenishment_urgency, replenishment_status, count(DISTINCT atm_id) AS atm_count,
       CAST(sum(ooc_events) AS BIGINT) AS total_ooc_events, {_mean('cash_utilization_pct')} AS avg_utilization_pct,
       sum(attempted_after_empty_mad) AS total_lost_mad
FROM replenishment_analysis GROUP BY replenishment_urgency, replenishment_status
""")
_answer("serve_fraud_risk", "SELECT * EXCLUDE (customer_key) FROM fraud_risk_scoring")
_answer("serve_fraud_risk_top", """
SELECT * EXCLUDE (customer_key) FROM fraud_risk_scoring ORDER BY fraud_risk_score DESC NULLS LAST, client_id LIMIT 20
""")
_answer("serve_fraud_summary", f"""
SELECT risk_level, income_segment, age_group, gender, count(*) AS customer_count,
       {_mean('fraud_risk_score')} AS avg_risk_score, CAST(sum(fraud_transactions) AS BIGINT) AS total_fraud_txns,
       {_mean('fraud_rate_pct', 4)} AS avg_fraud_rate_pct, CAST(sum(dark_web_cards) AS BIGINT) AS total_dark_web_cards
FROM fraud_risk_scoring GROUP BY risk_level, income_segment, age_group, gender
""")
_answer("serve_channel", """
SELECT * EXCLUDE (channel_key) REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date) FROM channel_comparison
""")
_answer("serve_channel_daily", """
SELECT channel_code, CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(sum(transactions) AS BIGINT) AS total_transactions, sum(total_amount_mad) AS total_amount_mad,
       round(avg(avg_amount_mad), 2) AS avg_amount_mad, CAST(sum(successful_txns) AS BIGINT) AS successful_txns,
       CAST(sum(reversals) AS BIGINT) AS reversals,
       round(sum(successful_txns) * 100.0 / nullif(sum(transactions), 0), 2) AS success_rate_pct
FROM channel_comparison GROUP BY ALL
""")
_answer("serve_channel_by_time", f"""
SELECT channel_code, time_of_day, CAST(sum(transactions) AS BIGINT) AS total_transactions,
       {_mean('success_rate_pct')} AS avg_success_rate_pct
FROM channel_comparison GROUP BY channel_code, time_of_day
""")
_answer("serve_customer_spending", "SELECT * EXCLUDE (customer_key) FROM customer_spending_behavior")
_answer("serve_spending_summary", f"""
SELECT activity_level, income_segment, age_group, preferred_category, count(*) AS customer_count,
       round(avg(total_spend_mad), 2) AS avg_total_spend_mad, round(avg(avg_spend_mad), 2) AS avg_transaction_mad,
       {_mean('online_ratio_pct')} AS avg_online_ratio_pct,
       {_mean('spend_to_income_ratio')} AS avg_spend_to_income, CAST(sum(fraud_txns) AS BIGINT) AS total_fraud_txns
FROM customer_spending_behavior GROUP BY activity_level, income_segment, age_group, preferred_category
""")
_answer("serve_governorate", "SELECT * FROM governorate_summary")
_answer("serve_customers", "SELECT * FROM dim_customer")

# --- write path and history ------------------------------------------------------

_answer("dedup_latest", """
SELECT refnum, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_hour, terminal_id, amount, resp_code
FROM typed_card_transactions QUALIFY row_number() OVER (PARTITION BY refnum ORDER BY transaction_date DESC) = 1
""")
_answer("high_watermark", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(max(transaction_date) AS VARCHAR) AS watermark FROM {t}"
    for t in ("fact_atm_transactions", "fact_card_transactions", "fact_wallet_transactions",
              "fact_out_of_cash_events")))
_answer("incremental_fact", """
SELECT card_transaction_key, transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, amount_mad
FROM fact_card_transactions
""")
for _key, _seen in (("late", "transaction_date >= DATE '2023-06-18'"), ("strict", "transaction_date > DATE '2023-06-20'"),
                    ("full", "TRUE")):
    _answer(f"incremental_fact_{_key}", f"""
SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, channel, amount_mad FROM silver_kaggle
WHERE channel <> 'ONLINE' OR {_seen}
""")
_answer("dedup_redelivered", """
SELECT upper(trim(terminal_id)) AS terminal_id, installation_date, CAST(type LIKE '%Dépôt%' AS INTEGER) AS batch_num,
       CAST(limits + CASE WHEN type LIKE '%Dépôt%' THEN 50000 ELSE 0 END AS DOUBLE) AS cash_limit
FROM raw_atm_master WHERE terminal_id IS NOT NULL
""")
_answer("stg_latest_load", """
SELECT client_id, credit_score + 10 AS credit_score, yearly_income AS yearly_income_mad FROM silver_customers
""")
_answer("upsert_by_key", """
SELECT mobile_number_masked, transaction_id, strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S.%f') AS transaction_datetime,
       amount_mad
FROM silver_wallet
QUALIFY row_number() OVER (PARTITION BY mobile_number_masked ORDER BY transaction_datetime DESC, transaction_id) = 1
""")
_answer("late_rows_counted", """
SELECT * FROM (WITH d AS (SELECT transaction_date AS day, CASE WHEN transaction_date <= DATE '2023-06-10' AND channel <> 'ONLINE' THEN 1
                  WHEN transaction_date <= DATE '2023-06-20' THEN 2 ELSE 3 END AS load FROM silver_kaggle),
seen AS (SELECT load, max(day) AS newest FROM d GROUP BY load),
until AS (SELECT load, max(newest) OVER (ORDER BY load) AS loaded_until,
                 max(newest) OVER (ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM seen)
SELECT CAST(load AS INTEGER) AS load, count(*) AS delivered, count(*) FILTER (WHERE day <= watermark) AS late,
       count(*) FILTER (WHERE day IS NULL) AS undated, CAST(any_value(loaded_until) AS VARCHAR) AS loaded_until
FROM d JOIN until USING (load) GROUP BY load)
""")
_answer("distinct_customers_sketch", """
SELECT channel, strftime(transaction_date, '%Y-%m') AS month, count(DISTINCT client_id) AS customers, TRUE AS within_bound
FROM silver_kaggle GROUP BY ALL
""")
_STATE = """SELECT client_id, card_id, channel, amount_bucket FROM silver_kaggle WHERE transaction_date {} DATE '2023-06-15'
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY transaction_datetime DESC, transaction_id) = 1"""
_FIRST, _SECOND = "2024-05-01 00:00:00", "2024-06-01 00:00:00"
_answer("scd2_snapshot", f"""
SELECT client_id, card_id, channel, amount_bucket, md5(client_id || '-' || updated_at || '.000000') AS scd_id,
       updated_at || '.000000' AS updated_at, updated_at || '.000000' AS valid_from, valid_to || '.000000' AS valid_to
FROM (SELECT o.*, '{_FIRST}' AS updated_at,
             CASE WHEN n.client_id IS NULL OR (o.card_id, o.channel, o.amount_bucket)
                       IS DISTINCT FROM (n.card_id, n.channel, n.amount_bucket) THEN '{_SECOND}' END AS valid_to
      FROM ({_STATE.format('<')}) o LEFT JOIN ({_STATE.format('>=')}) n ON o.client_id = n.client_id
      UNION ALL
      SELECT n.*, '{_SECOND}', NULL
      FROM ({_STATE.format('>=')}) n LEFT JOIN ({_STATE.format('<')}) o ON o.client_id = n.client_id
      WHERE o.client_id IS NULL OR (o.card_id, o.channel, o.amount_bucket)
            IS DISTINCT FROM (n.card_id, n.channel, n.amount_bucket))
""")
_answer("scd2_validity", """
SELECT client_id, CAST(transaction_date AS VARCHAR) AS transaction_date, purchases, spend,
       CAST(lead(transaction_date) OVER (PARTITION BY client_id ORDER BY transaction_date) AS VARCHAR) AS valid_to
FROM (SELECT client_id, transaction_date, count(*) AS purchases, sum(amount_mad) AS spend FROM silver_kaggle GROUP BY ALL)
""")
_CHANGES = """
SELECT mobile_number AS wallet, CAST(transaction_amount AS DOUBLE) AS amount,
       CASE WHEN transaction_type LIKE 'ANNULATION%' THEN 'D' ELSE 'U' END AS op, transaction_date AS ts
FROM raw_wallet_transactions 
QUALIFY row_number() OVER (PARTITION BY mobile_number ORDER BY transaction_date DESC) = 1
"""
for _key in ("cdc_apply", "stream_cdc_apply"):
    _answer(_key, f"""
SELECT wallet, amount, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM ({_CHANGES}) WHERE op <> 'D'
""")

# --- quality ---------------------------------------------------------------------

_REASONS = {
    "quarantine_atm_master": """
SELECT CAST(NULL AS VARCHAR) AS terminal_id, trim(governorate) AS region, trim(type) AS atm_type,
       trim(replenished_by) AS provider, trim(replenished_from) AS location_type, installation_date,
       CAST(limits AS DOUBLE) AS cash_limit, type LIKE '%Dépôt%' AS is_cash_deposit_enabled,
       CAST(floor((DATE '2024-06-01' - CAST(installation_date AS DATE)) / 365) AS INTEGER) AS atm_age_years,
       'Maroc' AS country, 'Attijariwafa Bank' AS bank_name, 'MAD' AS currency,
       'null_terminal_id' AS _reason, 'atm_master' AS _entity
FROM raw_atm_master WHERE terminal_id IS NULL
""",
    "quarantine_customers": """
SELECT *, 'null_client_id' AS _reason, 'customers' AS _entity FROM ruled_customers WHERE client_id IS NULL
""",
    "quarantine_cards": """
SELECT CAST(id AS VARCHAR) AS card_id, CAST(client_id AS VARCHAR) AS client_id, upper(trim(card_brand)) AS card_brand,
       upper(trim(card_type)) AS card_type, acct_open_date, 'null_card_or_client_id' AS _reason, 'cards' AS _entity
FROM (SELECT * REPLACE (CAST(CAST(strptime(acct_open_date, '%m/%Y') AS DATE) AS VARCHAR) AS acct_open_date)
      FROM raw_cards)
WHERE id IS NULL OR client_id IS NULL
""",
    "quarantine_card_transactions": """
SELECT t.* EXCLUDE (pan, amount) REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date), m.client_id,
       CASE WHEN terminal_id IS NULL THEN 'null_terminal_id' WHEN amount IS NULL THEN 'null_amount'
            WHEN amount < 0 THEN 'negative_amount' ELSE 'null_refnum' END AS _reason, 'card_transactions' AS _entity
FROM typed_card_transactions t LEFT JOIN pan_customer_map_silver m ON t.pan = m.pan_masked
WHERE terminal_id IS NULL OR amount IS NULL OR amount < 0 OR refnum IS NULL
""",
    "quarantine_wallet": """
SELECT * EXCLUDE (amount_raw) REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date,
                  strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S.%f') AS transaction_datetime),
       CASE WHEN amount_raw IS NULL THEN 'null_amount' ELSE 'null_id_or_negative_amount' END AS _reason,
       'wallet_transactions' AS _entity
FROM typed_wallet WHERE transaction_id IS NULL OR amount_raw IS NULL OR amount_raw < 0
""",
    "quarantine_out_of_cash": """
SELECT * REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date), 'null_required_field' AS _reason,
       'out_of_cash' AS _entity
FROM typed_out_of_cash WHERE refnum IS NULL OR terminal_id IS NULL OR attempted_amount_mad IS NULL
""",
    "quarantine_kaggle": """
SELECT transaction_id, client_id, card_id, amount_mad, merchant_id, 'null_transaction_or_client_id' AS _reason,
       'kaggle_transactions' AS _entity
FROM typed_kaggle WHERE transaction_id IS NULL OR client_id IS NULL
""",
}
for _key, _sql in _REASONS.items():
    _answer(_key, _sql)
_answer("quarantine_counts", "SELECT _entity AS entity, _reason AS reason, count(*) AS n_rows FROM ("
        + " UNION ALL ".join(f"SELECT _entity, _reason FROM ({sql})" for sql in _REASONS.values())
        + ") GROUP BY _entity, _reason")

# Columns per table, load and creation times included.
_WIDTH = {
    "raw_atm_master": 7, "raw_customers": 12, "raw_cards": 11, "raw_card_transactions": 9,
    "raw_wallet_transactions": 7, "raw_out_of_cash": 7, "raw_kaggle_transactions": 11,
    "silver_atm_master": 13, "silver_customers": 21, "silver_cards": 18, "silver_card_transactions": 16,
    "silver_wallet": 15, "silver_out_of_cash": 12, "silver_kaggle": 24, "pan_customer_map_silver": 4,
    "fact_atm_transactions": 22, "fact_card_transactions": 24, "fact_wallet_transactions": 17,
    "fact_out_of_cash_events": 15,
}
_answer("layer_health", " UNION ALL ".join(
    f"SELECT '{'raw' if t.startswith('raw') else 'facts' if t.startswith('fact') else 'silver'}' AS layer, "
    f"'{t}' AS table_name, count(*) AS n_rows, {n} AS n_columns, "
    f"{'CAST(NULL AS VARCHAR)' if t.startswith('raw') else RUN_TS} AS latest_load FROM {t}"
    for t, n in _WIDTH.items()))


def _failures(table: str, test: str, column: str, bad: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS column_name, "
            f"count(*) FILTER (WHERE {bad}) AS failures FROM {table}")


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).upper()


def _checks(test: str) -> str:
    parts = []
    for table, contract in CONTRACTS.items():
        if test == "not_null":
            parts += [_failures(table, test, c, f"{c} IS NULL") for c in contract.not_null]
        elif test == "accepted_values":
            parts += [_failures(table, test, c, f"{c} NOT IN ({', '.join(map(_literal, v))})")
                      for c, v in contract.values.items()]
        elif test == "accepted_range":
            parts += [_failures(table, test, c, f"{c} < {lo}" + ("" if hi is None else f" OR {c} > {hi}"))
                      for c, (lo, hi) in contract.ranges.items()]
        else:
            parts += [f"SELECT '{table}' AS table_name, 'unique' AS test, '{c}' AS column_name, count(*) AS failures "
                      f"FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
                      for c in contract.unique]
    return "\nUNION ALL\n".join(parts)


for _test in ("not_null", "unique", "accepted_values", "accepted_range"):
    _answer(f"dq_{_test}", _checks(_test))
_answer("dq_ref_integrity", """
SELECT atm_transaction_key AS record_id, atm_key AS failing_atm_key
FROM fact_atm_transactions f ANTI JOIN (SELECT atm_key FROM dim_atm WHERE region <> 'Oriental') d USING (atm_key)
WHERE atm_key IS NOT NULL
""")
_answer("dq_ref_integrity_cards", """
SELECT transaction_id AS record_id, card_id AS failing_card_id
FROM stg_transactions t ANTI JOIN dim_card d USING (card_id) WHERE card_id IS NOT NULL
""")
_answer("dq_no_negative_amounts", """
SELECT source_table, record_id, failing_amount FROM (
    SELECT 'fact_atm_transactions' AS source_table, refnum AS record_id,
           CASE WHEN is_reversal THEN -amount_mad ELSE amount_mad END AS failing_amount FROM fact_atm_transactions
    UNION ALL
    SELECT 'fact_wallet_transactions', wallet_transaction_key,
           CASE WHEN is_reversal THEN -amount_mad ELSE amount_mad END FROM fact_wallet_transactions)
WHERE failing_amount < 0
""")
# The valid response codes.
_VALID_CODES = "0, 14, 43, 51, 54, 57, 61, 91, 96"
_answer("dq_valid_resp_codes", f"""
SELECT atm_transaction_key AS record_id, resp_code AS failing_resp_code, 'atm' AS source
FROM fact_atm_transactions WHERE resp_code NOT IN ({_VALID_CODES})
UNION ALL
SELECT out_of_cash_key, resp_code, 'ooc' FROM fact_out_of_cash_events WHERE resp_code NOT IN ({_VALID_CODES})
""")
_answer("dq_wallet_positive", """
SELECT wallet_transaction_key AS record_id, amount_mad AS failing_amount FROM fact_wallet_transactions WHERE amount_mad <= 0
""")

# --- streaming -------------------------------------------------------------------

_answer("stream_bronze_ingest", f"""
SELECT * REPLACE ({_stamp('ts')}), 'events' AS source_table, 'd' || number AS batch_id, number AS batch_num,
       CASE WHEN event_id % 4 = 2 THEN 2 ELSE 1 END AS deliveries, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM (SELECT *, CAST(CASE WHEN event_id % 28 = 0 THEN 4 WHEN event_id % 4 = 2 THEN 5 ELSE event_id % 4 END AS INTEGER) AS number
      FROM events)
""".replace("SELECT * REPLACE", "SELECT * EXCLUDE (number) REPLACE"))
_answer("stream_dedup", """
SELECT refnum, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_hour, terminal_id, amount, resp_code
FROM typed_card_transactions QUALIFY row_number() OVER (PARTITION BY refnum ORDER BY transaction_date DESC) = 1
""")
_answer("stream_channel_hourly", """
SELECT channel, strftime(h, '%Y-%m-%d %H:%M:%S.%f') AS hour_start, count(*) AS transactions,
       sum(amount_mad) AS total_amount_mad
FROM (SELECT channel, amount_mad, date_trunc('hour', transaction_datetime) AS h FROM typed_wallet
      WHERE transaction_id IS NOT NULL AND amount_raw >= 0
      UNION ALL
      SELECT channel, amount_mad, transaction_date + transaction_hour * INTERVAL 1 HOUR FROM typed_card_transactions
      WHERE terminal_id IS NOT NULL AND amount >= 0 AND refnum IS NOT NULL)
GROUP BY channel, h
""")
_WALLETS = """
SELECT transaction_id, channel, mobile_number_masked AS wallet, transaction_datetime AS ts, amount_mad, is_reversal
FROM typed_wallet WHERE transaction_id IS NOT NULL AND amount_raw >= 0
"""
_answer("stream_dedup_window", f"""
SELECT DISTINCT transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, amount_mad, channel FROM ({_WALLETS})
""")
_answer("stream_late_rows", f"""
SELECT * FROM (WITH e AS (
    SELECT *, CASE WHEN NOT (wallet LIKE '%5' AND is_reversal) THEN ts END AS event_time,
           greatest(least(CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / 10) AS INTEGER), 2), 0)
             + CAST(wallet LIKE '%3' AS INTEGER) AS batch
    FROM ({_WALLETS})
), newest AS (SELECT batch, max(event_time) AS top FROM e GROUP BY batch),
before AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM newest)
SELECT transaction_id, CAST(batch AS INTEGER) AS batch, CASE WHEN event_time IS NULL THEN 'no_time' ELSE 'late' END AS reason, amount_mad
FROM e JOIN before USING (batch)
WHERE event_time IS NULL OR event_time < seen - INTERVAL 12 HOUR)
""")
