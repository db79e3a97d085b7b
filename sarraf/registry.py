"""Named queries over the star-schema test tables.

Upstream tables of a query are written once per session below the shared
folder and read from there; the query itself is a lazy plan over them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from sarraf.functions import fixed_values as fv, rules, text
from sarraf.operators import changes, conform, dedup, health, history, merge, quality, quarantine, sketches
from sarraf.plans import dims, gold, serve, silver, staging
from sarraf.plans.contracts import CONTRACTS
from sarraf.plans.lakehouse import SILVER
from sarraf.plans.warehouse import FACTS, MODELS, Warehouse, fraud_labels
from sarraf.schemas import LANDED_COLUMNS
from sarraf.settings import RunContext
from sarraf.sources import bankdata, labels, landing, run_results, tables
from sarraf.streaming import bronze, hourly, run, upsert

Query = Callable[[SparkSession, str], DataFrame]

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The stored warehouse of this session for one input folder."""
    session = (spark.sparkContext.applicationId, sf_dir)
    if session not in _warehouses:
        root = tables.scratch_dir(spark, "warehouse")
        _warehouses[session] = Warehouse(spark, bankdata.raw_tables(spark, sf_dir), root=root, computed_keys=True)
    return _warehouses[session]


def lazy_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse that writes nothing: each query is one plan from the raw tables."""
    return Warehouse(spark, bankdata.raw_tables(spark, sf_dir))


_SHOWN = ("_reason", "_entity")


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, load times left out: the same in every engine."""
    columns = []
    for f in df.schema.fields:
        if f.name.startswith("_") and f.name not in _SHOWN:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(c.alias(f.name))
    return df.select(columns)


_queries: dict[str, Query] = {}


def _register(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    _queries[name] = lambda spark, sf_dir: portable(build(warehouse(spark, sf_dir)))


def _register_on_inputs(name: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
    _queries[name] = lambda spark, sf_dir: portable(build(spark, sf_dir))


def queries() -> dict[str, Query]:
    return dict(_queries)


# --- sources and columns -----------------------------------------------------------

def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered by status, in batches that do not all have the same columns."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    folder = tables.scratch_dir(spark, "landing")
    for number, status in enumerate(("F", "O", "P")):
        batch = orders.filter(F.col("o_orderstatus") == status)
        if status == "F":
            batch = batch.drop("o_orderpriority")
        elif status == "O":
            batch = batch.withColumn("Order Channel", F.lit("web"))
        landing.land_batch(batch, folder, "orders", status, number, RunContext())
    bronze = landing.to_bronze(landing.scan_landing(spark, folder), RunContext())
    return bronze.withColumn("source_folder", F.element_at(F.split("_source_file", "/"), -2)).drop("ingested_at")


def _staged_objects(wh: Warehouse) -> DataFrame:
    """The fraud labels as JSON objects of some thousand entries each."""
    pairs = wh.raw("raw_fraud_labels")
    objects = max(1, pairs.count() // 5000)
    return pairs.groupBy(F.pmod(F.xxhash64("transaction_id"), F.lit(objects)).alias("_object")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("transaction_id", "label")))).alias("value")
    ).select("value")


def _label_lines(wh: Warehouse) -> DataFrame:
    """Labels from JSON lines on storage, an object a line."""
    work = tables.scratch_dir(wh.spark, "label-lines")
    _staged_objects(wh).write.text(work)
    return labels.read_label_lines(wh.spark, work)


def _label_objects(wh: Warehouse) -> DataFrame:
    """Labels from JSON objects on storage, an object a file, read by splitting the files at commas."""
    work = tables.scratch_dir(wh.spark, "label-objects")
    _staged_objects(wh).write.option("maxRecordsPerFile", 1).text(work)
    return labels.read_label_object(wh.spark, work)


def _seed_use(wh: Warehouse) -> DataFrame:
    """The seeds and how many silver rows use each code.  No silver table is needed for that: the codes are counted by key."""
    def counts(entity: silver.Entity, raw: str, value: Column) -> DataFrame:
        return silver.kept_counts(entity, wh.raw(raw), wh.ctx, value)

    known = F.array(*[F.lit(row[1]) for row in fv.CHANNELS])
    place = F.array_position(known, F.col("channel"))
    channels = (
        counts(silver.CARD_TRANSACTIONS, "raw_card_transactions", place)
        .unionByName(counts(silver.WALLET_TRANSACTIONS, "raw_wallet_transactions", place))
        .unionByName(counts(silver.KAGGLE_TRANSACTIONS, "raw_kaggle_transactions", place))
        .filter("value > 0").groupBy(F.get(known, F.col("value") - 1).alias("code")).agg(F.sum("n").alias("n"))
    )
    codes = counts(silver.CARD_TRANSACTIONS, "raw_card_transactions", F.col("resp_code")).select(
        F.col("value").cast("string").alias("code"), "n"
    )

    def used(seed: DataFrame, name: str, key: str, code: str, label: str, counts: DataFrame) -> DataFrame:
        rows = seed.select(F.lit(name).alias("seed"), F.col(key).alias("seed_key"),
                           F.col(code).cast("string").alias("code"), F.col(label).alias("label"))
        return rows.join(counts, "code", "left").withColumn("n_transactions", F.coalesce("n", F.lit(0))).drop("n")

    return used(
        wh.table("dim_channel"), "channel", "channel_key", "channel_code", "channel_name", channels
    ).unionByName(
        used(wh.table("dim_error_type"), "error_type", "error_type_key", "error_code", "error_description", codes)
    )


def _run_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def node(uid, status, seconds, failures, message):
        return F.struct(
            uid.alias("unique_id"), status.alias("status"), seconds.cast("double").alias("execution_time"),
            failures.cast("bigint").alias("failures"), message.cast("string").alias("message"),
        )

    def nodes(line):
        return F.array(
            node(F.concat(F.lit("model.bank."), line["l_orderkey"]), line["l_linestatus"], line["l_quantity"] / 4, none, none),
            node(F.concat(F.lit("test.bank.not_null_"), line["l_partkey"], F.lit("."), line["l_linenumber"]),
                 line["l_returnflag"], F.lit(0.25), line["l_suppkey"], F.lit("checked")),
            node(F.concat(F.lit("seed_"), line["l_returnflag"]), line["l_linestatus"], none, none, none),
        )

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    none, used = F.lit(None), ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity")
    runs = max(1, lines.count() // 5000)
    # Only the columns of a line are shuffled; the nodes, several times as long, are made after that.
    documents = lines.groupBy((F.col("l_orderkey") % runs).alias("_run")).agg(F.collect_list(F.struct(*used)).alias("lines"))
    text_of = F.to_json(F.struct(F.flatten(F.transform("lines", nodes)).alias("results")))
    work = tables.scratch_dir(spark, "run-results")
    documents.select(text_of.alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(work)
    return run_results.read_run_results(spark, work)


def _converted(wh: Warehouse) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in ("MAD", "USD", "EUR", "GBP", "AED", "SAR", "XXX")])
    currency = F.get(codes, text.clock_hour(F.col("time")) % 7)
    return wh.raw("raw_card_transactions").withColumn("currency", currency).select(
        "refnum", "date", "currency",
        rules.convert_to_mad(F.col("amount"), F.col("currency")).alias("amount_mad"),
        rules.convert_to_mad(F.col("amount"), "EUR").alias("amount_mad_if_eur"),
    )


def _unsafe_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_nationkey") % 5
    balance = (
        F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("inf")))
        .when(kind == 2, F.lit(float("-inf"))).otherwise(F.col("c_acctbal"))
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return serve.json_safe(customers.select("c_custkey", balance.alias("balance")))


_register_on_inputs("bronze_ingest", _bronze)
_register("fraud_labels_explode", _label_lines)
_register("fraud_labels_object", _label_objects)
_register("seed_dims", _seed_use)
_register_on_inputs("run_results_flatten", _run_nodes)
_register_on_inputs("run_results_by_status", lambda spark, sf_dir: run_results.run_health(_run_nodes(spark, sf_dir)))
_register(
    "conform_atm_master",
    lambda wh: conform.harmonise(wh.raw("raw_atm_master"), silver.ATM_SYNONYMS, silver.ATM_COLUMNS),
)
_register(
    "error_code_clean",
    lambda wh: wh.raw("raw_kaggle_transactions").select(
        F.col("id").alias("transaction_id"), "errors", text.error_code(F.col("errors")).alias("error_code_clean")
    ),
)
_register("convert_to_mad", _converted)
_register_on_inputs("json_safe", _unsafe_balances)
_register(
    "classify_risk_level",
    lambda wh: wh.table("fraud_risk_scoring").select(
        "client_id",
        rules.classify_risk_level(F.col("fraud_rate_pct"), F.col("debt_risk_level"), F.col("dark_web_cards"))
        .alias("risk_class"),
    ),
)
_register(
    "classify_risk_score",
    lambda wh: wh.table("fraud_risk_scoring").select(
        "client_id", rules.classify_risk_score(F.col("fraud_risk_score")).alias("score_class")
    ),
)

# --- silver to marts ---------------------------------------------------------------

for _name in MODELS:
    if _name not in ("dim_channel", "dim_error_type", "dim_date"):
        _register(_name, lambda wh, name=_name: wh.plan(name))


def _calendar_use(wh: Warehouse) -> DataFrame:
    def per_day(fact: str, name: str) -> DataFrame:
        return wh.fact(fact).groupBy(F.col("transaction_date").alias("full_date")).agg(F.count("*").alias(name))

    return (
        wh.table("dim_date")
        .join(per_day("fact_card_transactions", "purchases"), "full_date", "left")
        .join(per_day("fact_atm_transactions", "atm_transactions"), "full_date", "left")
        .fillna(0, ["purchases", "atm_transactions"])
    )


_register("dim_date", _calendar_use)
_register(
    "dim_geography_literal",
    lambda wh: dims.dim_geography(wh.table("stg_atm_master"), wh.table("stg_transactions"), literal=True),
)
_register("primary_card", lambda wh: dims.primary_cards(wh.table("dim_card")))
_register(
    "top_category",
    lambda wh: gold.top_category(
        wh.fact("fact_card_transactions", "customer", "category"), wh.table("dim_merchant_category")
    ).drop("unique_categories"),
)
_register(
    "atm_performance_full_calendar",
    lambda wh: gold.atm_performance(
        wh.table("dim_atm"), wh.fact("fact_atm_transactions", "atm"), wh.fact("fact_out_of_cash_events", "atm"),
        wh.fact("fact_wallet_transactions", "atm"), wh.ctx, full_calendar=True,
    ),
)
_register(
    "channel_comparison_literal",
    lambda wh: gold.channel_comparison(
        wh.table("dim_channel"), wh.fact("fact_atm_transactions", "channel"),
        wh.fact("fact_wallet_transactions", "channel"), wh.fact("fact_card_transactions", "channel"), wh.ctx,
        literal_success=True,
    ),
)
_register(
    "customer_spending_behavior_literal",
    lambda wh: gold.customer_spending_behavior(
        wh.table("dim_customer"), wh.fact("fact_card_transactions", "client", "category"),
        wh.table("dim_merchant_category"), wh.ctx, literal_night=True, step=wh.step,
    ),
)

# --- serving -----------------------------------------------------------------------

for _name, _mart, _view in (
    ("serve_atm_performance", "atm_performance", serve.atm_performance),
    ("serve_atm_by_region", "atm_performance", serve.atm_by_region),
    ("serve_atm_by_grade", "atm_performance", serve.atm_by_grade),
    ("serve_replenishment", "replenishment_analysis", serve.replenishment),
    ("serve_replenishment_by_urgency", "replenishment_analysis", serve.replenishment_by_urgency),
    ("serve_fraud_risk", "fraud_risk_scoring", serve.fraud_risk),
    ("serve_fraud_summary", "fraud_risk_scoring", serve.fraud_summary),
    ("serve_channel", "channel_comparison", serve.channel_comparison),
    ("serve_channel_daily", "channel_comparison", serve.channel_daily),
    ("serve_channel_by_time", "channel_comparison", serve.channel_by_time),
    ("serve_customer_spending", "customer_spending_behavior", serve.customer_spending),
    ("serve_spending_summary", "customer_spending_behavior", serve.spending_summary),
    ("serve_governorate", "governorate_summary", serve.governorate),
    ("serve_customers", "dim_customer", serve.customers),
):
    _register(_name, lambda wh, mart=_mart, view=_view: view(wh.table(mart)))

_register("serve_fraud_risk_top", lambda wh: serve.fraud_risk(wh.table("fraud_risk_scoring"), limit=20))

# --- write path and history --------------------------------------------------------

def _typed_card_transactions(wh: Warehouse) -> DataFrame:
    typed = silver.CARD_TRANSACTIONS.typed(wh.raw("raw_card_transactions"))
    return typed.withColumnRenamed("amount_raw", "amount").select(
        "refnum", "transaction_date", "transaction_hour", "terminal_id", "amount", "resp_code"
    )


def _wallet_state(wh: Warehouse, period) -> DataFrame:
    rows = wh.table("silver_wallet").filter(period).select(
        "mobile_number_masked", "transaction_id", "transaction_datetime", "amount_mad"
    )
    return dedup.latest_per_key(rows, "mobile_number_masked", "transaction_datetime", ["transaction_id"])


def _upserted(wh: Warehouse) -> DataFrame:
    """The last row of every wallet: those of later days go into those of the days before."""
    later = F.coalesce(F.col("transaction_date") >= F.lit("2024-01-20").cast("date"), F.lit(False))
    return merge.upsert_by_key(_wallet_state(wh, ~later), _wallet_state(wh, later), "mobile_number_masked")


def _incremental(wh: Warehouse) -> DataFrame:
    fact = wh.fact("fact_card_transactions").select(
        "card_transaction_key", "transaction_id", "transaction_date", "amount_mad"
    )
    loaded = fact.filter(F.col("transaction_date") <= F.lit("2023-06-20").cast("date"))
    newest = merge.high_watermark(loaded, "transaction_date")
    return merge.upsert_by_key(loaded, merge.rows_to_load(fact, "transaction_date", newest, 2), "card_transaction_key")


def _late_purchases(wh: Warehouse, **options) -> DataFrame:
    """A second load where online purchases of the first days come late; ``options`` say which rows it looks at."""
    purchases = wh.table("silver_kaggle").select("transaction_id", "transaction_date", "channel", "amount_mad")
    first_days = F.col("transaction_date") <= F.lit("2023-06-20").cast("date")
    loaded = purchases.filter(first_days & (F.col("channel") != "ONLINE"))
    newest = None if options.pop("full", False) else merge.high_watermark(loaded, "transaction_date")
    return merge.upsert_by_key(loaded, merge.rows_to_load(purchases, "transaction_date", newest, **options), "transaction_id")


def _late_counts(wh: Warehouse) -> DataFrame:
    """Three deliveries of purchases, online ones of the first days late; each load takes later days only and counts the rest."""
    number = F.when((F.col("transaction_date") <= "2023-06-10") & (F.col("channel") != "ONLINE"), 1).when(
        F.col("transaction_date") <= "2023-06-20", 2
    ).otherwise(3)
    purchases = wh.table("silver_kaggle").select("transaction_id", "transaction_date", number.alias("number"))
    path, counts, newest = tables.scratch_dir(wh.spark, "late"), [], None
    for load in (1, 2, 3):
        seen = Observation()
        kept = merge.without_late(purchases.filter(F.col("number") == load), "transaction_date", newest, seen)
        tables.write(kept, path, "number", only_touched=True)
        newest = merge.high_watermark(tables.read(wh.spark, path), "transaction_date")
        counts.append({"load": load, "loaded_until": str(newest), **tables.observed(seen, delivered=0, late=0, undated=0)})
    return wh.spark.createDataFrame(counts, "load int, delivered long, late long, undated long, loaded_until string")


def _sketched_customers(wh: Warehouse) -> DataFrame:
    """Distinct customers per channel and month from daily sketches, and whether the estimate keeps its bound."""
    rows = wh.table("silver_kaggle").select(
        "channel", "transaction_date", "client_id", F.date_format("transaction_date", "yyyy-MM").alias("month")
    )
    daily = sketches.daily_sketches(rows, ["channel", "transaction_date", "month"], "client_id")
    exact = rows.groupBy("channel", "month").agg(F.countDistinct("client_id").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers"))
    return exact.join(sketches.united(daily, "channel", "month"), ["channel", "month"]).select(
        "channel", "month", "customers", (off <= F.ceil(F.col("customers") * sketches.bound())).alias("within_bound")
    )


def _redelivered(wh: Warehouse) -> DataFrame:
    """Terminals delivered twice with the same dates, the second time with a higher limit for cash deposits."""
    first = silver.ATM_MASTER.typed(wh.raw("raw_atm_master"))
    second = first.filter(F.col("atm_type").contains("Dépôt")).withColumn("cash_limit", F.col("cash_limit") + 50000)
    both = first.withColumn("batch_num", F.lit(0)).unionByName(second.withColumn("batch_num", F.lit(1)))
    known = both.filter(F.col("terminal_id").isNotNull()).select(
        "terminal_id", "installation_date", "cash_limit", "batch_num"
    )
    return dedup.latest_per_key(known, "terminal_id", "installation_date")


def _two_loads(wh: Warehouse) -> DataFrame:
    """Customers of two loads, the second with other credit scores."""
    old = wh.table("silver_customers")
    new = old.withColumns({
        "credit_score": F.col("credit_score") + 10, staging.LOADED_AT: F.col(staging.LOADED_AT) + F.expr("interval 1 day")
    })
    return staging.stg_customers(old.unionByName(new), keyed=False).select("client_id", "credit_score", "yearly_income_mad")


def _purchase_states(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The last purchase of every client before a day and from it on, from one pass that builds no silver table."""
    later = (F.col("transaction_date") >= F.lit("2023-06-15").cast("date")).alias("_later")
    used = ("client_id", "transaction_datetime", "transaction_id", "card_id", "use_chip", "amount_mad")
    rows = silver.kept(
        silver.KAGGLE_TRANSACTIONS, wh.raw("raw_kaggle_transactions"), *used, "transaction_date"
    ).select(*used, later)
    order = [F.col("transaction_datetime").desc_nulls_last(), F.col("transaction_id")]
    last = dedup.first_per_key(rows.filter(F.col("_later").isNotNull()), ["client_id", "_later"], order)
    states = silver.KAGGLE_TRANSACTIONS.derive(last, wh.ctx).select("client_id", "card_id", "channel", "amount_bucket", "_later")
    staged, _ = tables.stage(states, tables.scratch_dir(wh.spark, "states"))
    return staged.filter("NOT _later").drop("_later"), staged.filter("_later").drop("_later")


def _two_snapshots(wh: Warehouse) -> DataFrame:
    may = RunContext(run_ts=dt.datetime(2024, 5, 1))
    before, after = _purchase_states(wh)
    return history.apply_snapshot(
        history.open_history(before, "client_id", may.now()), after, "client_id",
        ["card_id", "channel", "amount_bucket"], wh.ctx.now(),
    )


def _daily_versions(wh: Warehouse) -> DataFrame:
    versions = wh.table("silver_kaggle").groupBy("client_id", "transaction_date").agg(
        F.count("*").alias("purchases"), F.sum("amount_mad").alias("spend")
    )
    return history.validity_ranges(versions, "client_id", "transaction_date", F.trunc("transaction_date", "month"))


def _wallet_changes(wallet: DataFrame) -> DataFrame:
    cancelled = F.col("transaction_type").startswith("ANNULATION")
    return wallet.select(
        F.col("mobile_number").alias("wallet"), F.col("transaction_amount").cast("double").alias("amount"),
        F.col("transaction_date").alias("ts"), F.when(cancelled, "D").otherwise("U").alias("op"),
    )


def _changed_wallets(wh: Warehouse) -> DataFrame:
    """All changes in two feeds, one after the other."""
    feed = _wallet_changes(wh.raw("raw_wallet_transactions"))
    later = F.coalesce(F.col("ts") >= F.lit("2024-01-16").cast("timestamp"), F.lit(False))
    nobody = feed.limit(0).drop("op")
    target = changes.apply_changes(nobody, feed.filter(~later), "wallet", ["ts"])
    return changes.apply_changes(target, feed.filter(later), "wallet", ["ts"])


_register("dedup_latest", lambda wh: dedup.latest_per_key(_typed_card_transactions(wh), "refnum", "transaction_date"))
_register("high_watermark", lambda wh: health.watermarks({f: wh.fact(f) for f in FACTS}, "transaction_date"))
_register("upsert_by_key", _upserted)
_register("incremental_fact", _incremental)
_register("incremental_fact_late", lambda wh: _late_purchases(wh, lateness_days=2))
_register("incremental_fact_strict", lambda wh: _late_purchases(wh, strict=True))
_register("incremental_fact_full", lambda wh: _late_purchases(wh, full=True))
_register("late_rows_counted", _late_counts)
_register("distinct_customers_sketch", _sketched_customers)
_register("dedup_redelivered", _redelivered)
_register("stg_latest_load", _two_loads)
_register("scd2_snapshot", _two_snapshots)
_register("scd2_validity", _daily_versions)
_register("cdc_apply", _changed_wallets)

# --- quality -----------------------------------------------------------------------

_RAW_OF = {entity: raw for entity, raw in SILVER.values()}


def _quarantined(wh: Warehouse, entity: str) -> DataFrame:
    return silver.quarantine(silver.ENTITIES[entity], wh.raw(_RAW_OF[entity]), wh.ctx)


_register("quarantine_atm_master", lambda wh: _quarantined(wh, "atm_master"))
_register("quarantine_customers", lambda wh: _quarantined(wh, "customers"))
_register(
    "quarantine_cards",
    lambda wh: _quarantined(wh, "cards").select(
        "card_id", "client_id", "card_brand", "card_type", "acct_open_date", "_reason", "_entity"
    ),
)
_register(
    "quarantine_card_transactions",
    lambda wh: silver.card_transactions_quarantine(
        wh.raw("raw_card_transactions"), wh.table("silver_customers"), wh.ctx
    ),
)
_register("quarantine_wallet", lambda wh: _quarantined(wh, "wallet_transactions"))
_register("quarantine_out_of_cash", lambda wh: _quarantined(wh, "out_of_cash"))
_register(
    "quarantine_kaggle",
    lambda wh: silver.kaggle_transactions_quarantine(wh.raw("raw_kaggle_transactions"), fraud_labels(wh), wh.ctx)
    .select("transaction_id", "client_id", "card_id", "amount_mad", "merchant_id", "_reason", "_entity"),
)
_register(
    "quarantine_counts",
    lambda wh: health.quarantine_counts({e: _quarantined(wh, e) for e in silver.ENTITIES}),
)


def _ledger(fact: DataFrame) -> DataFrame:
    return fact.withColumn("amount_mad", F.when(F.col("is_reversal"), -F.col("amount_mad")).otherwise(F.col("amount_mad")))


def _layers(wh: Warehouse) -> DataFrame:
    raw = [n for n in bankdata.RAW_SQL if n != "raw_fraud_labels"]
    kept = [n for n in MODELS if n.startswith("silver_") or n == "pan_customer_map_silver"]
    return health.layer_health(
        {
            "raw": {n: wh.raw(n) for n in raw},
            "silver": {n: wh.table(n) for n in kept},
            "facts": {n: wh.table(n) for n in FACTS},
        }
    )


_register("layer_health", _layers)
for _test in ("not_null", "unique", "accepted_values", "accepted_range"):
    _register(
        f"dq_{_test}",
        lambda wh, test=_test: quality.check_tables(
            {n: wh.table(n) for n, contract in CONTRACTS.items() if quality.declares(contract, [test])}, CONTRACTS, [test]
        ),
    )
_register(
    "dq_ref_integrity",
    # The terminals of one region are taken out, so that there are orphans.
    lambda wh: quality.broken_references(
        wh.table("fact_atm_transactions"), wh.table("dim_atm").filter("region <> 'Oriental'"), "atm_key",
        "atm_transaction_key",
    ),
)
_register(
    "dq_ref_integrity_cards",
    lambda wh: quality.broken_references(wh.table("stg_transactions"), wh.table("dim_card"), "card_id", "transaction_id"),
)
_register(
    "dq_no_negative_amounts",
    # As a ledger that books reversals negative; stored amounts have no sign.
    lambda wh: quality.negative_amounts(
        _ledger(wh.table("fact_atm_transactions")), _ledger(wh.table("fact_wallet_transactions"))
    ),
)
_register(
    "dq_valid_resp_codes",
    lambda wh: quality.invalid_resp_codes(wh.table("fact_atm_transactions"), wh.table("fact_out_of_cash_events")),
)
_register(
    "dq_wallet_positive", lambda wh: quality.wallet_amounts_not_positive(wh.table("fact_wallet_transactions"))
)

# --- streaming ---------------------------------------------------------------------

def _streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in six deliveries, a micro-batch each: four parts, rows that come late, and the third part once more.

    One row per event: the delivery that counts, and how often it was delivered.
    """
    work, ctx = tables.scratch_dir(spark, "stream-land"), RunContext()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part, late = F.col("event_id") % 4, F.col("event_id") % 28 == 0
    schema = StructType([*events.schema.fields, *StructType.fromDDL(LANDED_COLUMNS).fields])
    for number, picked in enumerate((*((part == n) & ~late for n in range(4)), late, part == 2)):
        landing.land_batch(events.filter(picked), f"{work}/landing", "events", f"d{number}", number, ctx)
        bronze.ingest_new(spark, f"{work}/landing", f"{work}/bronze", f"{work}/checkpoint", schema, ctx, "ts")
    rows = tables.read(spark, f"{work}/bronze")
    times = rows.groupBy("event_id").agg(F.count("*").alias("deliveries"))
    last = dedup.latest_per_key(rows.drop("source_file", "ingested_at"), "event_id", "ts")
    return last.join(times, "event_id").withColumn("day", F.col(bronze.DAY).cast("string"))


def _landed(wh: Warehouse, frame: DataFrame, work: str) -> DataFrame:
    """A stream over rows that were landed as files, a few files per micro-batch."""
    landed, _ = tables.stage(frame, f"{work}/landing")
    return run.open_files(wh.spark, f"{work}/landing", landed.schema, files_per_batch=8)


def _streamed_dedup(wh: Warehouse) -> DataFrame:
    work = tables.scratch_dir(wh.spark, "stream-dedup")
    stream = _landed(wh, _typed_card_transactions(wh), work)
    upsert.upsert_stream(
        stream, f"{work}/table", "refnum", "transaction_date", f"{work}/checkpoint", partition="transaction_date"
    )
    return tables.read(wh.spark, f"{work}/table")


def _streamed_changes(wh: Warehouse) -> DataFrame:
    work = tables.scratch_dir(wh.spark, "stream-cdc")
    feed = _landed(wh, _wallet_changes(wh.raw("raw_wallet_transactions")), work)
    upsert.apply_change_stream(feed, f"{work}/table", "wallet", "ts", f"{work}/checkpoint")
    return upsert.live_rows(tables.read(wh.spark, f"{work}/table"))


def _deliveries(frame: DataFrame, number: Column, work: str, last: int):
    """Writes the rows of one delivery after the other; yields a stream of what is there."""
    for n in range(last + 1):
        frame.filter(number == n).write.mode("append").parquet(f"{work}/landing")
        yield run.open_files(frame.sparkSession, f"{work}/landing", frame.schema)


def _wallet_events(wh: Warehouse) -> DataFrame:
    wallet = silver.WALLET_TRANSACTIONS
    rows = wallet.derive(quarantine.good_rows(wallet.typed(wh.raw("raw_wallet_transactions")), wallet.checks()), wh.ctx)
    return rows.withColumn("event_time", F.col("transaction_datetime"))


def _streamed_hours(wh: Warehouse) -> DataFrame:
    """Terminals and wallets in four deliveries that overlap in time."""
    work, card = tables.scratch_dir(wh.spark, "stream-hourly"), silver.CARD_TRANSACTIONS
    rows = card.derive(quarantine.good_rows(card.typed(wh.raw("raw_card_transactions")), card.checks()), wh.ctx)
    moment = F.try_to_timestamp(F.concat_ws(" ", "transaction_date", "transaction_hour"), F.lit("yyyy-MM-dd H"))
    wanted = ["channel", "event_time", "amount_mad"]
    events = rows.withColumn("event_time", moment).select(wanted).unionByName(_wallet_events(wh).select(wanted))
    for stream in _deliveries(events, F.pmod(F.xxhash64(*wanted), F.lit(4)), work, 3):
        hourly.keep_hours(stream, f"{work}/hours", f"{work}/late", f"{work}/checkpoint", dt.timedelta(days=90))
    return hourly.hours(wh.spark, f"{work}/hours")


def _streamed_late(wh: Warehouse) -> DataFrame:
    """Wallet events by ten days, some wallets a delivery late and some without times: what the hours leave aside."""
    work, user = tables.scratch_dir(wh.spark, "stream-late"), F.col("mobile_number_masked")
    events = _wallet_events(wh).withColumn(
        "event_time", F.when(~(user.endswith("5") & F.col("is_reversal")), F.col("event_time"))
    )
    tens = F.least(F.floor(F.datediff("transaction_date", F.lit("2024-01-01")) / 10), F.lit(2))
    rows = events.withColumn("part", (F.greatest(tens, F.lit(0)) + user.endswith("3").cast("int")).cast("int"))
    rows = rows.select("channel", "event_time", "amount_mad", "transaction_id", "part")
    for stream in _deliveries(rows, F.col("part"), work, 3):
        hourly.keep_hours(stream, f"{work}/hours", f"{work}/late", f"{work}/checkpoint", dt.timedelta(hours=12))
    return tables.read(wh.spark, f"{work}/late").select("transaction_id", "batch", F.col("_reason").alias("reason"), "amount_mad")


def _streamed_once(wh: Warehouse) -> DataFrame:
    """Wallet rows of four deliveries, each with the rows of the one before once more; repeats go while a span is open."""
    work = tables.scratch_dir(wh.spark, "stream-once")
    rows = _wallet_events(wh).select("transaction_id", "event_time", "amount_mad", "channel")
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(4))
    twice = rows.withColumn("part", part).unionByName(rows.withColumn("part", part + 1).filter("part < 4"))

    def keep(batch: DataFrame, number: int) -> None:
        tables.write(batch.withColumn("batch", F.lit(number)), f"{work}/table", "batch", only_touched=True)

    for stream in _deliveries(twice, F.col("part"), work, 3):
        once = upsert.first_seen(stream, "transaction_id", "event_time", "90 days")
        run.run_available(once, keep, f"{work}/checkpoint")
    return tables.read(wh.spark, f"{work}/table").drop("batch", "part")


_register_on_inputs("stream_bronze_ingest", _streamed_bronze)
_register("stream_dedup", _streamed_dedup)
_register("stream_cdc_apply", _streamed_changes)
_register("stream_channel_hourly", _streamed_hours)
_register("stream_late_rows", _streamed_late)
_register("stream_dedup_window", _streamed_once)
