"""Raw banking records derived from the star-schema test tables.

Each text runs on Spark and on DuckDB; ``{table}`` stands for an input table
(``{customer_cards}`` for the customers, each with k = 0, 1 and 2).
Keys repeat, values are missing, negative or padded on purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

RAW_SQL = {
    "raw_customers": """
SELECT CASE WHEN c_custkey % 211 = 9 THEN NULL ELSE c_custkey END AS id, 18 + c_custkey % 60 AS current_age, 65 AS retirement_age,
       2024 - (18 + c_custkey % 60) AS birth_year, 1 + c_custkey % 12 AS birth_month,
       CASE c_custkey % 2 WHEN 0 THEN ' male ' ELSE 'Female' END AS gender,
       33.5E0 + (c_custkey % 8) * 0.25E0 AS latitude, -7.5E0 + (c_custkey % 16) * 0.25E0 AS longitude,
       concat('$', CAST(20000 + (c_custkey * 7919) % 330000 AS STRING)) AS yearly_income,
       concat(CAST((c_custkey * 104729) % 90000 AS STRING), ' MAD') AS total_debt,
       300 + (c_custkey * 31) % 551 AS credit_score, c_custkey % 7 AS num_credit_cards
FROM {customer}
""",
    "raw_cards": """
SELECT c_custkey * 3 + k AS id, CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE c_custkey END AS client_id,
       CASE k WHEN 0 THEN 'Visa' WHEN 1 THEN ' Mastercard' ELSE 'CMI' END AS card_brand,
       CASE k WHEN 0 THEN 'Débit' WHEN 1 THEN 'Crédit' ELSE 'Prepaid' END AS card_type,
       lpad(CAST(c_custkey * 3 + k AS STRING), 16, '4') AS card_number, '123' AS cvv,
       CASE c_custkey % 5 WHEN 0 THEN 'yes' ELSE 'no' END AS has_chip,
       concat('$', CAST(1000 + (c_custkey * 37 + k) % 20000 AS STRING)) AS credit_limit,
       concat(lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '/', CAST(2008 + c_custkey % 16 AS STRING)) AS acct_open_date,
       concat(lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '/', CAST(2021 + c_custkey % 8 AS STRING)) AS expires,
       CASE (c_custkey + k) % 40 WHEN 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web
FROM {customer_cards}
""",
    "raw_atm_master": """
SELECT CASE WHEN s_suppkey % 100 = 9 THEN NULL ELSE concat(' atm', lpad(CAST(s_suppkey AS STRING), 4, '0')) END AS terminal_id,
       CASE s_nationkey % 6 WHEN 0 THEN 'Casablanca-Settat' WHEN 1 THEN 'Marrakech-Safi' WHEN 2 THEN 'Oriental'
            WHEN 3 THEN 'Fès-Meknès' WHEN 4 THEN 'Souss-Massa' ELSE 'Dakhla' END AS governorate,
       CASE s_suppkey % 2 WHEN 0 THEN 'Retrait & Dépôt' ELSE 'Retrait uniquement' END AS type,
       'Bank' AS replenished_by, 'Branch' AS replenished_from,
       CAST(DATE '2016-01-01' + CAST((s_suppkey % 11) * 365 AS INT) AS STRING) AS installation_date,
       200000 + (s_suppkey % 4) * 300000 AS limits
FROM {supplier}
""",
    "raw_card_transactions": """
SELECT CAST(o_orderkey AS STRING) AS refnum,
       concat('****', lpad(CAST(o_custkey AS STRING), 6, '0')) AS pan,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('atm', lpad(CAST(o_orderkey % 30 AS STRING), 4, '0'), ' ') END AS termid,
       CAST(DATE '2024-01-01' + CAST(floor(o_orderkey / 30) % 30 AS INT)  AS STRING) AS date,
       concat(lpad(CAST((o_orderkey * 7) % 24 AS STRING), 2, '0'), ':15:00') AS time,
       CASE o_orderstatus WHEN 'F' THEN 'Dépôt' ELSE 'Retrait' END AS descr,
       CASE o_orderkey % 25 WHEN 0 THEN 430 ELSE 210 END AS msgtype,
       CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN -100.0E0 ELSE CAST(floor(o_totalprice / 20) AS DOUBLE) END AS amount,
       CASE WHEN (CAST(floor(o_orderkey / 900) AS INT) * 37 + o_orderkey) % 100 < (o_orderkey % 4) * 9 THEN CASE o_orderkey % 3 WHEN 0 THEN 96 WHEN 1 THEN 51 ELSE 14 END WHEN o_orderkey % 331 = 7 THEN 77 ELSE 0 END AS respcode
FROM {orders}
UNION ALL
SELECT CAST(o_orderkey AS STRING) AS refnum,
       concat('****', lpad(CAST(o_custkey AS STRING), 6, '0')) AS pan,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('atm', lpad(CAST(o_orderkey % 30 AS STRING), 4, '0'), ' ') END AS termid,
       CAST(DATE '2024-01-01' + CAST(floor(o_orderkey / 30) % 30 AS INT) - 1 AS STRING) AS date,
       concat(lpad(CAST((o_orderkey * 7) % 24 AS STRING), 2, '0'), ':15:00') AS time,
       CASE o_orderstatus WHEN 'F' THEN 'Dépôt' ELSE 'Retrait' END AS descr,
       CASE o_orderkey % 25 WHEN 0 THEN 430 ELSE 210 END AS msgtype,
       CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN -100.0E0 ELSE CAST(floor(o_totalprice / 20) AS DOUBLE) END AS amount,
       CASE WHEN (CAST(floor(o_orderkey / 900) AS INT) * 37 + o_orderkey) % 100 < (o_orderkey % 4) * 9 THEN CASE o_orderkey % 3 WHEN 0 THEN 96 WHEN 1 THEN 51 ELSE 14 END WHEN o_orderkey % 331 = 7 THEN 77 ELSE 0 END AS respcode
FROM {orders} WHERE o_orderkey % 50 = 0
""",
    "raw_wallet_transactions": """
SELECT CASE WHEN event_id % 109 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS transaction_id,
       concat('06', lpad(CAST(user_id AS STRING), 8, '0')) AS mobile_number,
       concat('atm', lpad(CAST(user_id % 30 AS STRING), 4, '0')) AS term_id,
       CAST(ts AS TIMESTAMP) AS transaction_date,
       CASE event_type WHEN 'purchase' THEN 'DEMANDE RETRAIT' WHEN 'error' THEN 'ANNULATION RETRAIT' ELSE 'DEMANDE DÉPÔT' END AS transaction_type,
       CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_id % 127 = 3 THEN -floor(value * 4) / 4 ELSE floor(value * 4) / 4 END AS transaction_amount,
       CASE event_type WHEN 'error' THEN '00091 KO' ELSE '00000 OK' END AS transaction_status
FROM {events}
""",
    "raw_out_of_cash": """
SELECT concat('ooc', CAST(event_id AS STRING)) AS refnum,
       concat('****', lpad(CAST(user_id AS STRING), 6, '0')) AS pan,
       concat('atm', lpad(CAST(user_id % 30 AS STRING), 4, '0')) AS termid,
       CAST(CAST(ts AS DATE) AS STRING) AS date,
       concat(lpad(CAST(event_id % 24 AS STRING), 2, '0'), ':30:00') AS time,
       CASE WHEN event_id % 37 = 5 THEN NULL ELSE concat(CAST(CAST(floor(value) AS BIGINT) AS STRING), ' MAD') END AS amount, 96 AS respcode
FROM {events} WHERE event_type = 'error'
""",
    "raw_kaggle_transactions": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
       CASE WHEN l_orderkey % 251 = 1 THEN NULL WHEN o_custkey % 10 = 7 THEN o_custkey - 1 ELSE o_custkey END AS client_id,
       CASE WHEN o_custkey % 10 = 7 THEN o_custkey - 1 ELSE o_custkey END * 3 + l_linenumber % 3 AS card_id,
       concat(CAST(DATE '2023-06-01' + CAST((l_orderkey + l_linenumber * 7) % (1 + o_custkey % 40) AS INT) AS STRING), ' ', lpad(CAST(l_partkey % 24 AS STRING), 2, '0'), ':00:00') AS date,
       concat('$', CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '-' ELSE '' END,
              CAST(CAST(l_quantity * CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 20 WHEN 2 THEN 100 ELSE 400 END AS INT) AS STRING), '.50') AS amount,
       CASE l_linenumber % 3 WHEN 0 THEN 'Online Transaction' WHEN 1 THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip,
       l_partkey AS merchant_id, p_brand AS merchant_city,
       CASE l_partkey % 3 WHEN 0 THEN 'Oriental' WHEN 1 THEN 'Rabat-Salé-Kénitra' ELSE NULL END AS merchant_state,
       CASE l_partkey % 10 WHEN 0 THEN '6011' WHEN 1 THEN '5411' WHEN 2 THEN '5812' WHEN 3 THEN '5541' WHEN 4 THEN '4111'
            WHEN 5 THEN '5310' WHEN 6 THEN '7011' WHEN 7 THEN '5912' WHEN 8 THEN '7995' ELSE '9999' END AS mcc,
       CASE l_suppkey % 20 WHEN 0 THEN '51' WHEN 1 THEN ' 14 ' WHEN 2 THEN 'Bad PIN' ELSE 'NaN' END AS errors
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
""",
    "raw_fraud_labels": """
SELECT DISTINCT concat(CAST(l_orderkey AS STRING), '-', CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_linenumber AS STRING) END) AS transaction_id,
       CASE WHEN (o_custkey % 8 = 0 AND l_orderkey % 4 = 0) OR (o_custkey % 8 = 1 AND l_orderkey % 16 = 0) OR l_orderkey % 200 = 0 THEN 'Yes' ELSE 'No' END AS label
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
""",
}

INPUTS = ("customer", "supplier", "part", "orders", "lineitem", "events")


def read_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in INPUTS}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Raw tables by name, each made on demand."""
    inputs = read_inputs(spark, sf_dir)
    inputs["customer_cards"] = inputs["customer"].withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))

    def maker(sql: str) -> Callable[[], DataFrame]:
        used = {name: frame for name, frame in inputs.items() if "{" + name + "}" in sql}
        return lambda: spark.sql(sql, **used)

    return {name: maker(sql) for name, sql in RAW_SQL.items()}
