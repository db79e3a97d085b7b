"""The tables of the warehouse as SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

from sarraf.sources.bankdata import INPUTS, RAW_SQL

AS_OF = "DATE '2024-06-01'"

_NAMES = {name: name for name in INPUTS}
_NAMES["customer_cards"] = "(SELECT *, unnest([0, 1, 2]) AS k FROM customer) cc"

_MONEY = r"TRY_CAST(regexp_replace(CAST({0} AS VARCHAR), '[^0-9.\-]', '', 'g') AS DOUBLE)"


def _money(column: str) -> str:
    return _MONEY.format(column)


def _key(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _yes(column: str) -> str:
    return f"upper(trim({column})) IN ('YES', 'OUI', 'TRUE', '1')"


TABLES: dict[str, str] = {name: sql.format(**_NAMES) for name, sql in RAW_SQL.items()}

# --- silver --------------------------------------------------------------------

TABLES["silver_atm_master"] = f"""
SELECT upper(trim(terminal_id)) AS terminal_id, trim(governorate) AS region, trim(type) AS atm_type,
       trim(replenished_by) AS provider, trim(replenished_from) AS location_type,
       CAST(installation_date AS DATE) AS installation_date, CAST(limits AS DOUBLE) AS cash_limit,
       type LIKE '%Deposit%' OR type LIKE '%Dépôt%' AS is_cash_deposit_enabled,
       CAST(floor(({AS_OF} - CAST(installation_date AS DATE)) / 365) AS INTEGER) AS atm_age_years,
       'Maroc' AS country, 'Attijariwafa Bank' AS bank_name, 'MAD' AS currency
FROM raw_atm_master WHERE terminal_id IS NOT NULL
"""

TABLES["ruled_customers"] = f"""
SELECT *, CASE WHEN current_age < 30 THEN '18-29' WHEN current_age < 45 THEN '30-44'
               WHEN current_age < 60 THEN '45-59' ELSE '60+' END AS age_group,
       CASE WHEN yearly_income < 60000 THEN 'LOW' WHEN yearly_income < 150000 THEN 'MEDIUM'
            WHEN yearly_income < 300000 THEN 'HIGH' ELSE 'PREMIUM' END AS income_segment,
       CASE WHEN credit_score >= 750 THEN 'EXCELLENT' WHEN credit_score >= 670 THEN 'GOOD'
            WHEN credit_score >= 580 THEN 'FAIR' ELSE 'POOR' END AS credit_tier,
       CASE WHEN yearly_income > 0 THEN round(total_debt / yearly_income, 2) END AS debt_to_income_ratio,
       'Maroc' AS country, 'MAD' AS currency
FROM (SELECT CAST(id AS VARCHAR) AS client_id, CAST(current_age AS INTEGER) AS current_age,
             CAST(retirement_age AS INTEGER) AS retirement_age, CAST(birth_year AS INTEGER) AS birth_year,
             CAST(birth_month AS INTEGER) AS birth_month, upper(trim(gender)) AS gender,
             CAST(NULL AS VARCHAR) AS address, latitude, longitude, CAST(NULL AS DOUBLE) AS per_capita_income,
             {_money('yearly_income')} AS yearly_income, {_money('total_debt')} AS total_debt,
             CAST(credit_score AS INTEGER) AS credit_score, CAST(num_credit_cards AS INTEGER) AS num_credit_cards
      FROM raw_customers)
"""

TABLES["silver_customers"] = "SELECT * FROM ruled_customers WHERE client_id IS NOT NULL"

TABLES["silver_cards"] = f"""
SELECT CAST(id AS VARCHAR) AS card_id, CAST(client_id AS VARCHAR) AS client_id,
       upper(trim(card_brand)) AS card_brand, upper(trim(card_type)) AS card_type,
       repeat('*', length(card_number) - 4) || right(card_number, 4) AS card_number_masked,
       {_yes('has_chip')} AS has_chip, 1 AS num_cards_issued, {_money('credit_limit')} AS credit_limit,
       CAST(strptime(acct_open_date, '%m/%Y') AS DATE) AS acct_open_date,
       CAST(NULL AS INTEGER) AS year_pin_last_changed, {_yes('card_on_dark_web')} AS card_on_dark_web,
       CAST(strptime(expires, '%m/%Y') AS DATE) AS expires_date,
       CAST(strptime(expires, '%m/%Y') AS DATE) < {AS_OF} AS is_expired,
       CAST(floor(({AS_OF} - CAST(strptime(acct_open_date, '%m/%Y') AS DATE)) / 365) AS INTEGER) AS card_age_years,
       CASE WHEN {_yes('card_on_dark_web')} THEN 'HIGH' ELSE 'LOW' END AS dark_web_risk,
       CASE WHEN upper(trim(card_type)) IN ('CREDIT', 'CRÉDIT') THEN 'CREDIT'
            WHEN upper(trim(card_type)) IN ('DEBIT', 'DÉBIT') THEN 'DEBIT' ELSE 'OTHER' END AS card_category,
       'MAD' AS currency
FROM raw_cards WHERE id IS NOT NULL AND client_id IS NOT NULL
"""

TABLES["client_index"] = """
SELECT client_id, row_number() OVER (ORDER BY md5(client_id), client_id) - 1 AS idx,
       count(*) OVER () AS n
FROM (SELECT DISTINCT client_id FROM silver_customers)
"""

TABLES["pan_customer_map_silver"] = """
SELECT p.pan_masked, p.pan_num, c.client_id
FROM (SELECT DISTINCT trim(pan) AS pan_masked, TRY_CAST(regexp_extract(pan, '(\\d+)', 1) AS BIGINT) AS pan_num
      FROM raw_card_transactions) p
LEFT JOIN client_index c ON p.pan_num % (SELECT count(*) FROM silver_customers) = c.idx
WHERE p.pan_num > 0
"""

TABLES["typed_card_transactions"] = """
SELECT trim(pan) AS pan, trim(refnum) AS refnum, upper(trim(termid)) AS terminal_id,
       CAST(date AS DATE) AS transaction_date, TRY_CAST(substr(time, 1, 2) AS INTEGER) AS transaction_hour,
       trim(descr) AS transaction_type, CAST(msgtype AS INTEGER) AS msg_type, amount,
       abs(amount) AS amount_mad, CAST(respcode AS INTEGER) AS resp_code, respcode = 0 AS is_successful,
       msgtype = 430 AS is_reversal, respcode = 96 AS is_out_of_cash,
       trim(descr) IN ('Dépôt', 'Deposit') AS is_deposit, 'CARD_ATM' AS channel, 'MAD' AS currency
FROM raw_card_transactions
"""

TABLES["silver_card_transactions"] = """
SELECT t.* EXCLUDE (pan, amount), m.client_id
FROM (SELECT * FROM typed_card_transactions
      WHERE terminal_id IS NOT NULL AND amount >= 0 AND refnum IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY refnum ORDER BY transaction_date DESC NULLS LAST) = 1) t
LEFT JOIN pan_customer_map_silver m ON t.pan = m.pan_masked
"""

TABLES["typed_wallet"] = """
SELECT trim(transaction_id) AS transaction_id, trim(mobile_number) AS mobile_number_masked,
       upper(trim(term_id)) AS terminal_id, transaction_date AS transaction_datetime,
       CAST(transaction_date AS DATE) AS transaction_date, CAST(hour(transaction_date) AS INTEGER) AS transaction_hour,
       trim(transaction_type) AS transaction_type, CAST(transaction_amount AS DOUBLE) AS amount_raw, abs(CAST(transaction_amount AS DOUBLE)) AS amount_mad,
       trim(transaction_status) AS transaction_status,
       transaction_type LIKE '%ANNULATION%' OR transaction_type LIKE '%REVERSAL%' AS is_reversal,
       transaction_type LIKE '%RETRAIT%' OR transaction_type LIKE '%OUT%' AS is_cash_out,
       transaction_status LIKE '00000%' AS is_successful, 'MOBILE_WALLET' AS channel, 'MAD' AS currency
FROM raw_wallet_transactions
"""

TABLES["silver_wallet"] = """
SELECT * EXCLUDE (amount_raw) FROM typed_wallet WHERE transaction_id IS NOT NULL AND amount_raw >= 0
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_datetime DESC NULLS LAST) = 1
"""

TABLES["typed_out_of_cash"] = f"""
SELECT trim(pan) AS pan, trim(refnum) AS refnum, upper(trim(termid)) AS terminal_id,
       CAST(date AS DATE) AS transaction_date, time AS transaction_time,
       TRY_CAST(substr(time, 1, 2) AS INTEGER) AS transaction_hour, {_money('amount')} AS attempted_amount_mad,
       CAST(respcode AS INTEGER) AS resp_code, 'GUICHET VIDE' AS failure_reason,
       respcode = 96 AS is_confirmed_ooc, 'MAD' AS currency
FROM raw_out_of_cash
"""

TABLES["silver_out_of_cash"] = """
SELECT * FROM typed_out_of_cash
WHERE refnum IS NOT NULL AND terminal_id IS NOT NULL AND attempted_amount_mad IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY refnum ORDER BY transaction_date DESC) = 1
"""

TABLES["typed_kaggle"] = f"""
SELECT id AS transaction_id, CAST(client_id AS VARCHAR) AS client_id, CAST(card_id AS VARCHAR) AS card_id,
       CAST(date AS TIMESTAMP) AS transaction_datetime, CAST(CAST(date AS TIMESTAMP) AS DATE) AS transaction_date,
       CAST(hour(CAST(date AS TIMESTAMP)) AS INTEGER) AS transaction_hour,
       {_money('amount')} AS amount_mad, abs({_money('amount')}) AS amount_abs,
       {_money('amount')} < 0 AS is_negative_amount, trim(use_chip) AS use_chip,
       CAST(merchant_id AS VARCHAR) AS merchant_id, trim(merchant_city) AS merchant_city,
       trim(merchant_state) AS merchant_region, CAST(NULL AS VARCHAR) AS zip, mcc, errors,
       trim(use_chip) IN ('Online Transaction', 'Transaction en ligne') AS is_online,
       trim(use_chip) IN ('Chip Transaction', 'Transaction par puce') AS is_chip_transaction
FROM raw_kaggle_transactions
"""

TABLES["silver_kaggle"] = f"""
SELECT t.*, CASE WHEN amount_abs < 100 THEN 'MICRO' WHEN amount_abs < 500 THEN 'SMALL'
                 WHEN amount_abs < 2000 THEN 'MEDIUM' WHEN amount_abs < 10000 THEN 'LARGE'
                 ELSE 'VERY_LARGE' END AS amount_bucket,
       CASE WHEN is_online THEN 'ONLINE' WHEN is_chip_transaction THEN 'CARD_POS' ELSE 'CARD_SWIPE' END AS channel,
       'Maroc' AS country, 'MAD' AS currency, coalesce(l.is_fraud, FALSE) AS is_fraud
FROM (SELECT * FROM typed_kaggle WHERE transaction_id IS NOT NULL AND client_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY transaction_id
          ORDER BY transaction_datetime DESC NULLS LAST, merchant_id, amount_mad, client_id, card_id,
                   errors, mcc) = 1) t
LEFT JOIN (SELECT transaction_id, bool_or({_yes('label')}) AS is_fraud FROM raw_fraud_labels
           GROUP BY transaction_id) l USING (transaction_id)
"""

# --- staging -------------------------------------------------------------------

TABLES["stg_atm_master"] = """
SELECT terminal_id AS atm_id, region, atm_type, provider, location_type, installation_date,
       cash_limit AS cash_limit_mad, is_cash_deposit_enabled, atm_age_years, country, bank_name, currency
FROM silver_atm_master
"""
TABLES["stg_customers"] = """
SELECT * RENAME (per_capita_income AS per_capita_income_mad, yearly_income AS yearly_income_mad,
                 total_debt AS total_debt_mad)
FROM silver_customers
"""
TABLES["stg_cards"] = """
SELECT * EXCLUDE (credit_limit) REPLACE (
           coalesce(has_chip, FALSE) AS has_chip, coalesce(card_on_dark_web, FALSE) AS card_on_dark_web,
           coalesce(is_expired, FALSE) AS is_expired, coalesce(card_age_years, 0) AS card_age_years),
       credit_limit AS credit_limit_mad
FROM silver_cards
"""
TABLES["stg_atm_transactions"] = """
SELECT * RENAME (terminal_id AS atm_id) FROM silver_card_transactions WHERE refnum IS NOT NULL AND amount_mad >= 0
"""
TABLES["stg_card_transactions"] = """
SELECT * REPLACE (coalesce(is_successful, FALSE) AS is_successful, coalesce(is_reversal, FALSE) AS is_reversal,
                  coalesce(is_out_of_cash, FALSE) AS is_out_of_cash, coalesce(is_deposit, FALSE) AS is_deposit)
FROM silver_card_transactions WHERE refnum IS NOT NULL AND amount_mad >= 0
"""
TABLES["stg_wallet_transactions"] = """
SELECT * EXCLUDE (terminal_id) REPLACE (
           coalesce(is_reversal, FALSE) AS is_reversal, coalesce(is_cash_out, FALSE) AS is_cash_out,
           coalesce(is_successful, FALSE) AS is_successful),
       terminal_id AS atm_id
FROM silver_wallet WHERE transaction_id IS NOT NULL AND amount_mad >= 0
"""
TABLES["stg_out_of_cash"] = """
SELECT * EXCLUDE (pan, terminal_id, transaction_time), pan AS pan_masked, terminal_id AS atm_id
FROM silver_out_of_cash WHERE terminal_id IS NOT NULL AND refnum IS NOT NULL
"""
TABLES["stg_transactions"] = """
SELECT * REPLACE (coalesce(is_negative_amount, FALSE) AS is_negative_amount,
                  coalesce(is_online, FALSE) AS is_online,
                  coalesce(is_chip_transaction, FALSE) AS is_chip_transaction)
FROM silver_kaggle WHERE transaction_id IS NOT NULL AND client_id IS NOT NULL
"""

# --- seeds and dimensions --------------------------------------------------------

TABLES["dim_channel"] = """
SELECT * FROM (VALUES
  (1, 'CARD_ATM', 'Card ATM', 'Physical ATM card transaction', FALSE, TRUE),
  (2, 'MOBILE_WALLET', 'Mobile Wallet', 'Mobile wallet transaction via ATM', TRUE, TRUE),
  (3, 'CARD_POS', 'Card POS', 'Card transaction at point of sale', FALSE, FALSE),
  (4, 'ONLINE', 'Online', 'Online card transaction', TRUE, FALSE),
  (5, 'CARD_SWIPE', 'Card Swipe', 'Magnetic stripe card transaction', FALSE, FALSE))
  v(channel_key, channel_code, channel_name, channel_description, is_digital, is_atm)
"""
TABLES["dim_error_type"] = """
SELECT * FROM (VALUES
  (1, 0, 'Success', 'SUCCESS', FALSE, TRUE), (2, 96, 'ATM Out of Cash', 'OPERATIONAL', FALSE, TRUE),
  (3, 51, 'Insufficient Funds', 'DECLINED', FALSE, TRUE), (4, 14, 'Invalid Card Number', 'DECLINED', TRUE, TRUE),
  (5, 61, 'Withdrawal Limit Exceeded', 'DECLINED', FALSE, TRUE), (6, 43, 'Card Reported Stolen', 'FRAUD', TRUE, TRUE),
  (7, 54, 'Expired Card', 'DECLINED', FALSE, TRUE), (8, 57, 'Transaction Not Permitted', 'DECLINED', FALSE, TRUE),
  (9, 91, 'Bank System Unavailable', 'TECHNICAL', FALSE, TRUE), (10, NULL, 'No Error', 'SUCCESS', FALSE, FALSE))
  v(error_type_key, error_code, error_description, error_category, is_fraud_related, is_atm_related)
"""
TABLES["dim_date"] = """
SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, CAST(week(d) AS INTEGER) AS week_number,
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       CAST(day(d) AS INTEGER) AS day_of_month, dayofweek(d) IN (0, 6) AS is_weekend,
       strftime(d, '%m-%d') IN ('01-01', '01-11', '03-03', '05-01', '07-30', '08-14', '08-20', '11-06', '11-18')
           AS is_moroccan_holiday,
       year(d) || '-Q' || quarter(d) AS year_quarter, strftime(d, '%Y-%m') AS year_month
FROM range(TIMESTAMP '2023-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY) r(d)
"""
TABLES["dim_atm"] = f"""
SELECT *, {_key('atm_id')} AS atm_key,
       CASE WHEN atm_age_years <= 2 THEN 'NEW' WHEN atm_age_years <= 5 THEN 'ESTABLISHED' ELSE 'MATURE' END
           AS atm_maturity,
       CASE WHEN cash_limit_mad >= 1000000 THEN 'HIGH_CAPACITY' WHEN cash_limit_mad >= 800000 THEN 'MEDIUM_CAPACITY'
            ELSE 'LOW_CAPACITY' END AS capacity_tier
FROM stg_atm_master
"""
TABLES["dim_customer"] = f"""
SELECT *, {_key('client_id')} AS customer_key,
       CASE WHEN debt_to_income_ratio > 0.5 THEN 'HIGH_RISK' WHEN debt_to_income_ratio > 0.3 THEN 'MEDIUM_RISK'
            ELSE 'LOW_RISK' END AS debt_risk_level,
       CASE WHEN num_credit_cards >= 5 THEN 'HEAVY_USER' WHEN num_credit_cards >= 3 THEN 'MODERATE_USER'
            ELSE 'LIGHT_USER' END AS credit_usage_tier
FROM stg_customers
"""
TABLES["dim_card"] = f"""
SELECT *, {_key('card_id')} AS card_key, {_key('client_id')} AS customer_key,
       CASE WHEN card_on_dark_web THEN 'CRITICAL' WHEN is_expired THEN 'HIGH' WHEN card_age_years > 5 THEN 'MEDIUM'
            ELSE 'LOW' END AS card_risk_level
FROM stg_cards
"""
TABLES["dim_geography"] = f"""
SELECT {_key('region', 'country')} AS geography_key, region, country,
       CASE WHEN region IN ('Casablanca-Settat', 'Rabat-Salé-Kénitra', 'Tanger-Tétouan-Al Hoceïma', 'Fès-Meknès')
            THEN 'NORTH'
            WHEN region IN ('Marrakech-Safi', 'Souss-Massa', 'Drâa-Tafilalet', 'Guelmim-Oued Noun') THEN 'SOUTH'
            WHEN region IN ('Oriental', 'Béni Mellal-Khénifra') THEN 'EAST' ELSE 'OTHER' END AS macro_region,
       CASE WHEN region = 'Casablanca-Settat' THEN 'TIER_1'
            WHEN region IN ('Rabat-Salé-Kénitra', 'Tanger-Tétouan-Al Hoceïma', 'Fès-Meknès', 'Marrakech-Safi')
            THEN 'TIER_2' ELSE 'TIER_3' END AS population_tier,
       region IN (SELECT region FROM stg_atm_master WHERE region IS NOT NULL) AS is_atm_location,
       region IN (SELECT merchant_region FROM stg_transactions WHERE merchant_region IS NOT NULL)
           AS is_merchant_location
FROM (SELECT region, 'Morocco' AS country FROM stg_atm_master WHERE region IS NOT NULL
      UNION SELECT merchant_region, 'Morocco' FROM stg_transactions WHERE merchant_region IS NOT NULL)
"""
TABLES["dim_merchant"] = f"""
SELECT {_key('merchant_id')} AS merchant_key, merchant_id, merchant_city, merchant_region, zip, mcc AS mcc_code,
       coalesce(mcc = '6011', FALSE) AS is_atm_merchant,
       CASE WHEN mcc IN ('5411', '5412', '5422') THEN 'GROCERY' WHEN mcc IN ('5812', '5813', '5814') THEN 'FOOD_BEVERAGE'
            WHEN mcc IN ('5541', '5542', '5983') THEN 'FUEL' WHEN mcc IN ('4111', '4112', '4131') THEN 'TRANSPORT'
            WHEN mcc IN ('6011', '6012') THEN 'FINANCIAL' WHEN mcc IN ('5310', '5311', '5331') THEN 'RETAIL'
            WHEN mcc IN ('7011', '7012') THEN 'HOSPITALITY' ELSE 'OTHER' END AS merchant_category_group,
       'Morocco' AS country
FROM stg_transactions WHERE merchant_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY merchant_id
    ORDER BY merchant_city NULLS LAST, merchant_region NULLS LAST, zip NULLS LAST, mcc NULLS LAST) = 1
"""
TABLES["dim_merchant_category"] = f"""
SELECT {_key('mcc')} AS merchant_category_key, mcc AS mcc_code,
       CASE mcc WHEN '6011' THEN 'Automated Cash Disbursements' WHEN '5411' THEN 'Grocery Stores'
            WHEN '5812' THEN 'Eating Places & Restaurants' WHEN '5541' THEN 'Service Stations'
            WHEN '4111' THEN 'Transportation' WHEN '5310' THEN 'Discount Stores' WHEN '7011' THEN 'Hotels & Lodging'
            WHEN '5912' THEN 'Drug Stores & Pharmacies' WHEN '5045' THEN 'Electronics'
            WHEN '4814' THEN 'Telecommunication Services' ELSE 'MCC-' || mcc END AS mcc_description,
       CASE WHEN mcc IN ('6011', '6012', '6051') THEN 'Financial Services'
            WHEN mcc IN ('5411', '5422', '5812') THEN 'Food & Beverage' WHEN mcc IN ('5541', '5983') THEN 'Fuel'
            WHEN mcc IN ('4111', '4131', '4814') THEN 'Transport & Telecom'
            WHEN mcc IN ('5310', '5311', '5045') THEN 'Retail' WHEN mcc IN ('7011', '7012') THEN 'Hospitality'
            ELSE 'Other' END AS category_group,
       mcc IN ('6011', '7995', '5933') AS is_high_risk_mcc
FROM (SELECT DISTINCT mcc FROM stg_transactions WHERE mcc IS NOT NULL)
"""
TABLES["primary_card"] = """
SELECT client_id, card_id, card_key FROM dim_card
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY card_id) = 1
"""
TABLES["dim_pan_customer_map"] = f"""
SELECT {_key('p.pan_masked')} AS pan_key, p.pan_masked, p.pan_num AS pan_number, p.client_id, c.customer_key,
       k.card_id, k.card_key
FROM pan_customer_map_silver p LEFT JOIN dim_customer c USING (client_id)
LEFT JOIN primary_card k ON p.client_id = k.client_id
WHERE p.pan_masked IS NOT NULL
"""

# --- facts -----------------------------------------------------------------------

TABLES["fact_atm_transactions"] = f"""
SELECT {_key('s.refnum')} AS atm_transaction_key, d.date_key, c.customer_key, CAST(NULL AS VARCHAR) AS card_key,
       a.atm_key, h.channel_key, e.error_type_key, s.refnum, s.amount_mad, s.transaction_date, s.transaction_hour,
       s.transaction_type, s.msg_type, s.resp_code, s.is_successful, s.is_reversal, s.is_out_of_cash, s.is_deposit,
       s.client_id, s.currency
FROM stg_atm_transactions s LEFT JOIN dim_customer c ON s.client_id = c.client_id
LEFT JOIN dim_atm a ON s.atm_id = a.atm_id LEFT JOIN dim_channel h ON s.channel = h.channel_code
LEFT JOIN dim_error_type e ON CAST(s.resp_code AS VARCHAR) = CAST(e.error_code AS VARCHAR)
LEFT JOIN dim_date d ON s.transaction_date = d.full_date
"""
TABLES["fact_card_transactions"] = f"""
SELECT {_key('s.transaction_id')} AS card_transaction_key, d.date_key, c.customer_key, k.card_key, m.merchant_key,
       g.merchant_category_key, h.channel_key, e.error_type_key, s.transaction_id, s.amount_mad, s.amount_abs,
       s.is_fraud, s.is_online, s.is_chip_transaction, s.is_negative_amount, s.amount_bucket, s.transaction_date,
       s.transaction_hour, s.mcc AS mcc_code, s.errors, s.country, s.currency
FROM (SELECT *, TRY_CAST(nullif(trim(errors), 'NaN') AS INTEGER) AS error_code_clean FROM stg_transactions) s
LEFT JOIN dim_customer c ON s.client_id = c.client_id LEFT JOIN dim_card k ON s.card_id = k.card_id
LEFT JOIN dim_merchant m ON s.merchant_id = m.merchant_id LEFT JOIN dim_merchant_category g ON s.mcc = g.mcc_code
LEFT JOIN dim_channel h ON s.channel = h.channel_code LEFT JOIN dim_error_type e ON s.error_code_clean = e.error_code
LEFT JOIN dim_date d ON s.transaction_date = d.full_date
"""
TABLES["fact_wallet_transactions"] = f"""
SELECT {_key('s.transaction_id')} AS wallet_transaction_key, d.date_key, a.atm_key, h.channel_key, s.transaction_id,
       s.mobile_number_masked, s.amount_mad, s.transaction_date, s.transaction_hour, s.transaction_type,
       s.transaction_status, s.is_reversal, s.is_cash_out, s.is_successful, s.currency
FROM stg_wallet_transactions s LEFT JOIN dim_atm a ON s.atm_id = a.atm_id
LEFT JOIN dim_channel h ON s.channel = h.channel_code LEFT JOIN dim_date d ON s.transaction_date = d.full_date
"""
TABLES["fact_out_of_cash_events"] = f"""
SELECT {_key('s.refnum')} AS out_of_cash_key, d.date_key, a.atm_key, e.error_type_key, s.refnum, s.pan_masked,
       s.attempted_amount_mad, s.transaction_date, s.transaction_hour, s.resp_code, s.failure_reason,
       s.is_confirmed_ooc, s.currency
FROM stg_out_of_cash s LEFT JOIN dim_atm a ON s.atm_id = a.atm_id
LEFT JOIN dim_error_type e ON CAST(s.resp_code AS VARCHAR) = CAST(e.error_code AS VARCHAR)
LEFT JOIN dim_date d ON s.transaction_date = d.full_date
"""

# --- marts -----------------------------------------------------------------------

_CARD_DAYS = """
SELECT atm_key, transaction_date, count(*) AS n, count(*) FILTER (WHERE is_successful) AS ok,
       count(*) FILTER (WHERE is_reversal) AS rev, count(*) FILTER (WHERE is_deposit) AS dep,
       sum(amount_mad) AS amount, avg(amount_mad) AS mean
FROM fact_atm_transactions GROUP BY ALL
"""
_OOC_DAYS = """
SELECT atm_key, transaction_date, count(*) AS n, sum(attempted_amount_mad) AS amount, min(transaction_hour) AS first_hour
FROM fact_out_of_cash_events GROUP BY ALL
"""
_WALLET_DAYS = """
SELECT atm_key, transaction_date, count(*) AS n, sum(amount_mad) AS amount FROM fact_wallet_transactions GROUP BY ALL
"""
_ATM_COLUMNS = """
       d.atm_key, d.atm_id, d.region, d.atm_type, d.provider, d.cash_limit_mad, d.is_cash_deposit_enabled,
       d.capacity_tier, coalesce(c.n, 0) AS card_transactions, coalesce(c.ok, 0) AS successful_card_txns,
       coalesce(c.rev, 0) AS reversals, coalesce(c.dep, 0) AS deposits, coalesce(c.amount, 0) AS card_amount_mad,
       coalesce(c.mean, 0) AS avg_card_amount_mad, coalesce(o.n, 0) AS ooc_events,
       coalesce(o.amount, 0) AS attempted_amount_mad, coalesce(w.n, 0) AS wallet_transactions,
       coalesce(w.amount, 0) AS wallet_amount_mad, round(c.ok * 100.0 / nullif(c.n, 0), 2) AS success_rate_pct,
       coalesce(c.n, 0) + coalesce(w.n, 0) AS total_transactions,
       coalesce(c.amount, 0) + coalesce(w.amount, 0) AS total_amount_mad,
       CASE WHEN coalesce(o.n, 0) > 5 THEN 'D' WHEN c.ok * 100.0 / c.n >= 95 THEN 'A'
            WHEN c.ok * 100.0 / c.n >= 85 THEN 'B' WHEN c.ok * 100.0 / c.n >= 70 THEN 'C' ELSE 'D' END
           AS performance_grade
"""
TABLES["atm_performance"] = f"""
SELECT c.transaction_date, {_ATM_COLUMNS}
FROM dim_atm d LEFT JOIN ({_CARD_DAYS}) c ON d.atm_key = c.atm_key
LEFT JOIN ({_OOC_DAYS}) o ON d.atm_key = o.atm_key AND c.transaction_date = o.transaction_date
LEFT JOIN ({_WALLET_DAYS}) w ON d.atm_key = w.atm_key AND c.transaction_date = w.transaction_date
"""
TABLES["atm_performance_full_calendar"] = f"""
SELECT x.transaction_date, {_ATM_COLUMNS}
FROM dim_atm d
LEFT JOIN (SELECT atm_key, transaction_date FROM fact_atm_transactions
           UNION SELECT atm_key, transaction_date FROM fact_out_of_cash_events
           UNION SELECT atm_key, transaction_date FROM fact_wallet_transactions) x ON d.atm_key = x.atm_key
LEFT JOIN ({_CARD_DAYS}) c ON d.atm_key = c.atm_key AND c.transaction_date = x.transaction_date
LEFT JOIN ({_OOC_DAYS}) o ON d.atm_key = o.atm_key AND o.transaction_date = x.transaction_date
LEFT JOIN ({_WALLET_DAYS}) w ON d.atm_key = w.atm_key AND w.transaction_date = x.transaction_date
"""
TABLES["replenishment_analysis"] = f"""
SELECT *, round(dispensed_mad * 100.0 / nullif(cash_limit_mad, 0), 2) AS cash_utilization_pct,
       ooc_events > 0 AS ran_out_of_cash,
       CASE WHEN ooc_events > 3 THEN 'CRITICAL' WHEN ooc_events > 1 THEN 'HIGH' WHEN ooc_events = 1 THEN 'MEDIUM'
            ELSE 'LOW' END AS replenishment_urgency,
       CASE WHEN dispensed_mad * 100.0 / nullif(cash_limit_mad, 0) > 80 THEN 'URGENT'
            WHEN dispensed_mad * 100.0 / nullif(cash_limit_mad, 0) > 60 THEN 'SOON' ELSE 'OK' END AS replenishment_status
FROM (SELECT d.atm_key, d.atm_id, d.region, d.atm_type, d.provider, d.cash_limit_mad, d.capacity_tier,
             t.transaction_date AS activity_date, coalesce(t.amount, 0) AS dispensed_mad,
             coalesce(t.n, 0) AS card_transactions, coalesce(o.n, 0) AS ooc_events,
             coalesce(o.amount, 0) AS attempted_after_empty_mad, o.first_hour AS first_ooc_hour
      FROM dim_atm d
      LEFT JOIN (SELECT atm_key, transaction_date, sum(amount_mad) AS amount, count(*) AS n
                 FROM fact_atm_transactions WHERE is_successful = TRUE AND is_deposit = FALSE GROUP BY ALL) t
             ON d.atm_key = t.atm_key
      LEFT JOIN ({_OOC_DAYS}) o ON d.atm_key = o.atm_key AND t.transaction_date = o.transaction_date)
"""


def _channel_comparison(atm_ok: str, wallet_ok: str) -> str:
    def part(fact: str, ok: str, reversals: str, deposits: str) -> str:
        return f"""SELECT channel_key, transaction_date, transaction_hour, count(*) AS transactions,
            sum(amount_mad) AS total_amount_mad, avg(amount_mad) AS avg_amount_mad,
            CAST({ok} AS BIGINT) AS successful_txns, CAST({reversals} AS BIGINT) AS reversals,
            CAST({deposits} AS BIGINT) AS deposits
        FROM {fact} GROUP BY channel_key, transaction_date, transaction_hour"""

    flag = "sum(CASE WHEN {} THEN 1 ELSE 0 END)".format
    return f"""
SELECT c.*, d.channel_code, round(successful_txns * 100.0 / nullif(transactions, 0), 2) AS success_rate_pct,
       CASE WHEN transaction_hour BETWEEN 6 AND 11 THEN 'MORNING' WHEN transaction_hour BETWEEN 12 AND 17 THEN 'AFTERNOON'
            WHEN transaction_hour BETWEEN 18 AND 22 THEN 'EVENING' ELSE 'NIGHT' END AS time_of_day
FROM ({part('fact_atm_transactions', atm_ok, flag('is_reversal'), flag('is_deposit'))} UNION ALL
      {part('fact_wallet_transactions', wallet_ok, flag('is_reversal'), '0')} UNION ALL
      {part('fact_card_transactions', 'count(*)', '0', '0')}) c
LEFT JOIN dim_channel d ON c.channel_key = d.channel_key
"""


_OK = "sum(CASE WHEN is_successful THEN 1 ELSE 0 END)"
TABLES["channel_comparison"] = _channel_comparison(_OK, _OK)
TABLES["channel_comparison_literal"] = _channel_comparison("count(*)", "count(*)")

TABLES["top_category"] = """
SELECT t.customer_key, g.category_group AS preferred_category, sum(t.amount_mad) AS category_spend
FROM fact_card_transactions t LEFT JOIN dim_merchant_category g ON t.merchant_category_key = g.merchant_category_key
GROUP BY t.customer_key, g.category_group
QUALIFY row_number() OVER (PARTITION BY t.customer_key
    ORDER BY sum(t.amount_mad) DESC NULLS LAST, g.category_group NULLS LAST) = 1
"""


def _customer_spending(night: str) -> str:
    return f"""
SELECT c.customer_key, c.client_id, c.income_segment, c.credit_tier, c.age_group, c.gender, c.country,
       c.yearly_income_mad, c.credit_score, coalesce(s.n, 0) AS total_transactions,
       coalesce(s.spend, 0) AS total_spend_mad, coalesce(s.mean, 0) AS avg_spend_mad,
       coalesce(s.most, 0) AS max_spend_mad, coalesce(s.morning, 0) AS morning_txns,
       coalesce(s.afternoon, 0) AS afternoon_txns, coalesce(s.evening, 0) AS evening_txns,
       coalesce(s.night, 0) AS night_txns, coalesce(s.online, 0) AS online_txns, coalesce(s.fraud, 0) AS fraud_txns,
       coalesce(s.days, 0) AS active_days, coalesce(s.categories, 0) AS unique_categories,
       coalesce(p.preferred_category, 'UNKNOWN') AS preferred_category,
       round(coalesce(s.spend, 0) * 100.0 / nullif(c.yearly_income_mad, 0), 2) AS spend_to_income_ratio,
       round(coalesce(s.online, 0) * 100.0 / nullif(s.n, 0), 2) AS online_ratio_pct,
       CASE WHEN coalesce(s.n, 0) = 0 THEN 'INACTIVE' WHEN s.days >= 20 THEN 'VERY_ACTIVE' WHEN s.days >= 10 THEN 'ACTIVE'
            WHEN s.days >= 3 THEN 'OCCASIONAL' ELSE 'RARE' END AS activity_level
FROM dim_customer c
LEFT JOIN (SELECT customer_key, count(*) AS n, sum(amount_mad) AS spend, avg(amount_mad) AS mean,
                  max(amount_mad) AS most,
                  count(*) FILTER (WHERE transaction_hour BETWEEN 6 AND 11) AS morning,
                  count(*) FILTER (WHERE transaction_hour BETWEEN 12 AND 17) AS afternoon,
                  count(*) FILTER (WHERE transaction_hour BETWEEN 18 AND 22) AS evening,
                  count(*) FILTER (WHERE {night}) AS night,
                  count(*) FILTER (WHERE is_online) AS online, count(*) FILTER (WHERE is_fraud) AS fraud,
                  count(DISTINCT transaction_date) AS days, count(DISTINCT merchant_category_key) AS categories
           FROM fact_card_transactions GROUP BY customer_key) s ON c.customer_key = s.customer_key
LEFT JOIN top_category p ON c.customer_key = p.customer_key
"""


TABLES["customer_spending_behavior"] = _customer_spending("transaction_hour >= 23 OR transaction_hour <= 5")
TABLES["customer_spending_behavior_literal"] = _customer_spending("transaction_hour BETWEEN 23 AND 5")

TABLES["fraud_risk_scoring"] = """
SELECT *, least(100, round(fraud_rate_pct * 40 + CASE WHEN dark_web_cards > 0 THEN 30 ELSE 0 END
                 + CASE WHEN debt_risk_level = 'HIGH_RISK' THEN 15 ELSE 0 END
                 + CASE WHEN credit_tier = 'POOR' THEN 10 ELSE 0 END
                 + CASE WHEN max_amount_mad > 2000 THEN 5 ELSE 0 END, 2)) AS fraud_risk_score,
       CASE WHEN dark_web_cards > 0 THEN 'CRITICAL' WHEN fraud_rate_pct > 10 THEN 'HIGH'
            WHEN fraud_rate_pct > 5 OR debt_risk_level = 'HIGH_RISK' THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM (SELECT c.customer_key, c.client_id, c.income_segment, c.credit_tier, c.debt_risk_level, c.age_group, c.gender,
             c.country, coalesce(t.n, 0) AS total_transactions, coalesce(t.fraud, 0) AS fraud_transactions,
             coalesce(t.amount, 0) AS total_amount_mad, coalesce(t.mean, 0) AS avg_amount_mad,
             coalesce(t.most, 0) AS max_amount_mad, coalesce(t.rate, 0) AS fraud_rate_pct,
             coalesce(t.online, 0) AS online_transactions, coalesce(t.days, 0) AS active_days,
             coalesce(k.n, 0) AS total_cards, coalesce(k.dark, 0) AS dark_web_cards,
             coalesce(k.expired, 0) AS expired_cards, coalesce(k.top_limit, 0) AS max_credit_limit_mad
      FROM dim_customer c
      LEFT JOIN (SELECT customer_key, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS fraud,
                        sum(amount_mad) AS amount, avg(amount_mad) AS mean, max(amount_mad) AS most,
                        round(count(*) FILTER (WHERE is_fraud) * 100.0 / nullif(count(*), 0), 4) AS rate,
                        count(*) FILTER (WHERE is_online) AS online, count(DISTINCT transaction_date) AS days
                 FROM fact_card_transactions GROUP BY customer_key) t ON c.customer_key = t.customer_key
      LEFT JOIN (SELECT customer_key, count(*) AS n, count(*) FILTER (WHERE card_on_dark_web) AS dark,
                        count(*) FILTER (WHERE is_expired) AS expired, max(credit_limit_mad) AS top_limit
                 FROM dim_card GROUP BY customer_key) k ON c.customer_key = k.customer_key)
"""
TABLES["governorate_summary"] = """
SELECT *, atm_transactions + wallet_transactions AS total_transactions,
       atm_amount_mad + wallet_amount_mad AS total_amount_mad,
       round(successful_atm_txns * 100.0 / nullif(atm_transactions, 0), 2) AS atm_success_rate_pct,
       round(ooc_events * 100.0 / nullif(atm_transactions + ooc_events, 0), 2) AS ooc_rate_pct,
       round(wallet_transactions * 100.0 / nullif(atm_transactions + wallet_transactions, 0), 2) AS wallet_share_pct
FROM (SELECT g.region, g.country, g.macro_region, g.population_tier, coalesce(n.n, 0) AS total_atms,
             coalesce(a.n, 0) AS atm_transactions, coalesce(a.amount, 0) AS atm_amount_mad,
             coalesce(a.ok, 0) AS successful_atm_txns, coalesce(a.rev, 0) AS atm_reversals,
             coalesce(w.n, 0) AS wallet_transactions, coalesce(w.amount, 0) AS wallet_amount_mad,
             coalesce(w.ok, 0) AS successful_wallet_txns, coalesce(o.n, 0) AS ooc_events,
             coalesce(o.amount, 0) AS ooc_attempted_mad
      FROM dim_geography g
      LEFT JOIN (SELECT region, count(*) AS n FROM dim_atm GROUP BY region) n ON g.region = n.region
      LEFT JOIN (SELECT d.region, count(*) AS n, sum(f.amount_mad) AS amount,
                        count(*) FILTER (WHERE f.is_successful) AS ok, count(*) FILTER (WHERE f.is_reversal) AS rev
                 FROM fact_atm_transactions f JOIN dim_atm d ON f.atm_key = d.atm_key
                 WHERE d.region IS NOT NULL GROUP BY d.region) a ON g.region = a.region
      LEFT JOIN (SELECT d.region, count(*) AS n, sum(f.amount_mad) AS amount,
                        count(*) FILTER (WHERE f.is_successful) AS ok
                 FROM fact_wallet_transactions f JOIN dim_atm d ON f.atm_key = d.atm_key
                 WHERE d.region IS NOT NULL GROUP BY d.region) w ON g.region = w.region
      LEFT JOIN (SELECT d.region, count(*) AS n, sum(f.attempted_amount_mad) AS amount
                 FROM fact_out_of_cash_events f JOIN dim_atm d ON f.atm_key = d.atm_key
                 WHERE d.region IS NOT NULL GROUP BY d.region) o ON g.region = o.region)
"""


def _used(sql: str) -> set[str]:
    return {word for word in re.findall(r"\b[a-z_]+\b", sql) if word in TABLES}


def with_tables(sql: str) -> str:
    """``sql`` preceded by the tables it needs, in order of definition."""
    needed: set[str] = set()
    pending = _used(sql)
    while pending:
        needed |= pending
        pending = {u for name in pending for u in _used(TABLES[name])} - needed
    parts = [f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in needed]
    return f"WITH {', '.join(parts)}\n{sql}" if parts else sql
