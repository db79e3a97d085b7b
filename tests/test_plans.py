"""What the physical plans look like, and what hot keys do to them."""

import contextlib
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as project
from sarraf import registry
from sarraf.operators.dedup import latest_per_key
from sarraf.plans import facts, gold, silver
from sarraf.plans.warehouse import MODELS, Warehouse
from sarraf.sources import bankdata

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(n for n in project.queries() if not n.startswith("stream_")))
def test_no_cross_product_and_no_python(spark, name):
    plan = plan_of(project.queries()[name](spark, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF"):
        assert forbidden not in plan


@pytest.mark.parametrize("name", sorted(n for n in MODELS if n.startswith("fact_")))
def test_only_fixed_size_tables_are_broadcast_by_hint(spark, name):
    """With automatic broadcasts off, what is left are the seeds and the calendar."""
    wh = registry.warehouse(spark, SF_DIR)
    fixed = {"fact_card_transactions": 3, "fact_atm_transactions": 3}.get(name, 2)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(wh.plan(name))
    assert plan.count("BroadcastExchange") == fixed


def test_seed_use_writes_and_sorts_no_silver_table(spark, tmp_path):
    """Codes are counted by key and value: no table is built, whole rows are not ranked."""
    wh = Warehouse(spark, bankdata.raw_tables(spark, SF_DIR), root=str(tmp_path))
    plan = plan_of(registry._seed_use(wh))
    assert not wh.rows_written and not list(tmp_path.iterdir())
    assert "Window" not in plan


def test_snapshots_of_purchases_build_no_silver_table(spark, tmp_path):
    """The states come from the columns that decide: no labels, no cities, no copy of the purchases."""
    wh = Warehouse(spark, bankdata.raw_tables(spark, SF_DIR), root=str(tmp_path))
    registry._two_snapshots(wh)
    assert not wh.rows_written and not list(tmp_path.iterdir())
    plan = plan_of(silver.kept(silver.KAGGLE_TRANSACTIONS, wh.raw("raw_kaggle_transactions"), "client_id", "use_chip"))
    assert "l_partkey" in plan and "p_brand" not in plan and "l_suppkey" not in plan


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = plan_of(registry.lazy_warehouse(spark, SF_DIR).plan("silver_kaggle"))
    before, after = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert before < after and "Exchange hashpartitioning(transaction_id" in plan[before:after]


def test_labels_join_without_another_shuffle_of_purchases(spark):
    """Dedup and label join share the partitioning by id."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(registry.lazy_warehouse(spark, SF_DIR).plan("silver_kaggle"))
    assert plan.count("Exchange hashpartitioning(transaction_id") == 2      # purchases and labels


def test_key_checks_reach_the_scan(spark):
    wh = registry.warehouse(spark, SF_DIR)
    plan = wh.table("stg_transactions")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(transaction_id), IsNotNull(client_id)]" in plan


def test_marts_read_few_columns(spark):
    wh = registry.warehouse(spark, SF_DIR)
    plan = plan_of(wh.plan("fraud_risk_scoring"))
    assert "merchant_key" not in plan and "errors" not in plan


def test_watermark_prunes_date_partitions(spark):
    from sarraf.operators.merge import high_watermark, rows_to_load

    fact = registry.warehouse(spark, SF_DIR).table("fact_card_transactions")
    newest = high_watermark(fact, "transaction_date")
    plan = plan_of(rows_to_load(fact, "transaction_date", newest))
    assert "PartitionFilters: [((transaction_date" in plan


def test_lazy_mart_joins_only_the_dimensions_it_uses(spark):
    plan = plan_of(registry.lazy_warehouse(spark, SF_DIR).plan("channel_comparison"))
    assert "merchant_key" not in plan and "customer_key" not in plan


def test_a_third_of_the_rows_in_one_key(spark):
    """Exact results with a hot key."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")))
    df = spark.range(n, numPartitions=8).select(key.alias("key"), F.col("id").alias("seq"), (F.col("id") % 97).alias("v"))
    got = {r["key"]: (r["seq"], r["v"]) for r in latest_per_key(df, "key", "seq").collect()}
    best = {}
    for i in range(n):
        best["hot" if i % 3 == 0 else f"k{i % 1000}"] = (i, i % 97)
    assert got == best


def test_skewed_fact_join_is_split(spark):
    """A client with a third of all rows does not end up in one task of the join."""
    wh = registry.warehouse(spark, SF_DIR)
    copies = F.explode(F.sequence(F.lit(0), F.lit(39)))
    hot = wh.table("stg_transactions").repartition(8, "transaction_id").withColumn("copy", copies).withColumn(
        "client_id", F.when(F.col("copy") < 14, F.lit("1")).otherwise(F.col("client_id"))
    )
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
    ):
        joined = facts.fact_card_transactions(hot, wh.dims(["customer"]), wh.ctx, links=["customer"])
        assert len(joined.collect()) == hot.count()
        assert "skew=true" in plan_of(joined)


def test_customer_marts_hold_no_distinct_count(spark):
    """No row is copied per distinct count (Expand)."""
    wh = registry.warehouse(spark, SF_DIR)
    for name in ("customer_spending_behavior", "fraud_risk_scoring"):
        assert "Expand" not in plan_of(wh.plan(name))


def test_top_category_order(spark):
    facts_ = spark.createDataFrame(
        [("c", "k1", 5.0), ("c", "k2", 5.0), ("d", "k1", -1.0), ("d", None, -5.0), ("e", "k9", 1.0)],
        "customer_key string, merchant_category_key string, amount_mad double",
    )
    dim = spark.createDataFrame(
        [("k1", "Fuel"), ("k2", "Food")], "merchant_category_key string, category_group string"
    )
    got = {r["customer_key"]: (r["preferred_category"], r["unique_categories"])
           for r in gold.top_category(facts_, dim).collect()}
    assert got == {"c": ("Food", 2), "d": ("Fuel", 1), "e": (None, 1)}


def test_computed_keys_do_not_shuffle_the_fact(spark):
    """With broadcasts by size off, only distinct keys are shuffled; the fact meets the few unknown ones by broadcast."""
    from sarraf.functions.keys import surrogate_key
    from sarraf.plans import facts

    dim = spark.range(100).select(F.col("id").cast("string").alias("merchant_id")).withColumn("merchant_key", surrogate_key("merchant_id"))
    fact = spark.range(2000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") % 103).cast("string")).alias("m"), F.lit("wide" * 20).alias("payload")
    )
    looked_up = fact.join(dim, F.col("m") == F.col("merchant_id"), "left").select("m", "payload", "merchant_key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        computed = facts.with_computed_key(fact, dim, "merchant", F.col("m"))
        plan = computed._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "payload" in line and "Exchange" in line]
        assert not wide and "BroadcastHashJoin" in plan
        assert sorted(map(str, computed.collect())) == sorted(map(str, looked_up.collect()))
        assert computed.filter("m IS NOT NULL AND merchant_key IS NULL").count() == looked_up.filter("m IS NOT NULL AND merchant_key IS NULL").count() > 0
        none_missing = facts.with_computed_key(fact.filter("length(m) = 1"), dim, "merchant", F.col("m"))
        assert "Join" not in none_missing._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_more_unknown_keys_than_may_be_broadcast_are_joined(spark, monkeypatch):
    from sarraf.functions.keys import surrogate_key
    from sarraf.plans import facts

    monkeypatch.setattr(facts, "UNKNOWN_KEYS", 3)
    dim = spark.range(5).select(F.col("id").cast("string").alias("merchant_id")).withColumn("merchant_key", surrogate_key("merchant_id"))
    fact = spark.range(20).select(F.col("id").cast("string").alias("m"))
    got = facts.with_computed_key(fact, dim, "merchant", F.col("m"))
    assert got.columns == ["m", "merchant_key"] and got.filter("merchant_key IS NOT NULL").count() == 5


def test_daily_sketches_unite(spark):
    from sarraf.operators import sketches

    rows = spark.range(40_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7919).cast("string").alias("customer"))
    daily = sketches.daily_sketches(rows, ["day"], "customer")
    assert daily.count() == 30
    estimate = sketches.united(daily).first()["estimate"]
    assert abs(estimate - 7919) <= 7919 * sketches.bound()
    assert sketches.united(sketches.daily_sketches(rows.limit(0), ["day"], "customer"), "day").count() == 0


def test_uniqueness_is_one_scan_per_table(spark, rows):
    from sarraf.operators import quality

    frame = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "b", None), (None, "c", None)], "i int, s string, n string")
    checked = quality.check_unique(frame, "t", ["i", "s", "n"])
    assert plan_of(checked).count("Generate explode") == 1
    assert rows(checked) == [("t", "unique", "i", 1), ("t", "unique", "n", 0), ("t", "unique", "s", 1)]
    assert quality.check_unique(frame.limit(0), "t", ["i"]).first()["failures"] == 0


def test_upsert_keeps_every_wallet(spark):
    """Each wallet comes out with its last row, whatever its number ends in."""
    wh = registry.warehouse(spark, SF_DIR)
    last = wh.table("silver_wallet").groupBy("mobile_number_masked").agg(F.max("transaction_datetime").alias("ts"))
    want = {r["mobile_number_masked"]: r["ts"] for r in last.collect()}
    got = project.queries()["upsert_by_key"](spark, SF_DIR).withColumn("ts", F.to_timestamp("transaction_datetime"))
    assert {r["mobile_number_masked"]: r["ts"] for r in got.collect()} == want


def test_change_feed_keeps_every_wallet(spark):
    """The last change of each wallet decides, whatever its number ends in; only cancelled wallets are gone."""
    wh = registry.warehouse(spark, SF_DIR)
    last = wh.raw("raw_wallet_transactions").groupBy("mobile_number").agg(
        F.max_by("transaction_type", "transaction_date").alias("kind"), F.max("transaction_date").alias("ts")
    )
    want = {r["mobile_number"]: r["ts"] for r in last.collect() if not r["kind"].startswith("ANNULATION")}
    got = project.queries()["cdc_apply"](spark, SF_DIR).withColumn("ts", F.to_timestamp("ts"))
    assert {r["wallet"]: r["ts"] for r in got.collect()} == want


def test_run_documents_are_stored_packed(spark, tmp_path, monkeypatch):
    """A line gives three nodes of some 220 bytes of JSON; on storage they take a fraction of that."""
    from sarraf.sources import tables

    monkeypatch.setattr(tables, "scratch_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    nodes = project.queries()["run_results_flatten"](spark, SF_DIR).count()
    stored = sum(f.stat().st_size for f in (tmp_path / "run-results").glob("part-*"))
    assert stored < 60 * nodes / 3


def test_a_mart_reads_facts_without_a_copy(spark):
    """A fact with computed keys is read from its staged table: nothing of it is written, and it is not shuffled."""
    wh = registry.warehouse(spark, SF_DIR)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(wh.fact("fact_card_transactions", "customer", "card", "merchant", "category"))
    assert "Exchange" not in plan
    wh.table("fact_card_transactions")
    assert not [name for name in wh.rows_written if name.startswith("fact_")]


def _purchases(spark):
    """Ids that come once, twice and never; equal times, a NULL date, a missing client."""
    rows = [(f"t{i % 37}", None if i % 11 == 5 else f"c{i % 7}", f"k{i % 3}", None if i % 13 == 4 else f"2024-01-{1 + i % 4:02d} 0{i % 9}:00:00",
             f"${i % 5}.50", "Online Transaction", f"m{i % 4}", "Rabat", "Oriental", "5411", None) for i in range(120)] + [
        (None, "c1", "k", "2024-01-01 00:00:00", "$1", "Chip Transaction", "m", "x", "y", "5411", "51")]
    names = "id client_id card_id date amount use_chip merchant_id merchant_city merchant_state mcc errors".split()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def _labels(spark):
    return spark.createDataFrame(
        [("t1", "Yes"), ("t1", "No"), ("t2", "No"), ("t3", None), ("t4", "Yes"), (None, "Yes"), ("t99", "Yes")],
        "transaction_id string, label string",
    )


@pytest.mark.parametrize("nothing", [True, False])
def test_purchases_written_in_parts_are_whole(spark, rows, tmp_path, nothing):
    """the stored copy has the rows of the one plan; its steps leave no copy."""
    raw = {"raw_kaggle_transactions": lambda: _purchases(spark).limit(0 if nothing else 1000),
           "raw_fraud_labels": lambda: _labels(spark)}
    wh = Warehouse(spark, raw, root=str(tmp_path))
    stored, plan = wh.table("silver_kaggle"), Warehouse(spark, raw).plan("silver_kaggle")
    assert rows(stored, *plan.columns) == rows(plan) and sorted(stored.columns) == sorted(plan.columns)
    assert wh.rows_written["silver_kaggle"] == plan.count() == (0 if nothing else 37)
    assert not list((tmp_path / "steps").iterdir())


def test_parts_share_no_key_and_shuffle_a_share(spark):
    """a part is cut off before its rows are shuffled; keys of NULL are in no part twice."""
    entity, raw = silver.KAGGLE_TRANSACTIONS, _purchases(spark)
    ctx = Warehouse(spark, {}).ctx
    parts = [{r["transaction_id"] for r in silver.build(entity, raw, ctx, (n, 3)).collect()} for n in range(3)]
    assert sum(map(len, parts)) == len(set().union(*parts)) == 37 and all(parts)
    plan = plan_of(silver.build(entity, registry.lazy_warehouse(spark, SF_DIR).raw("raw_kaggle_transactions"), ctx, (0, 3)))
    scan = plan.rindex("xxhash64")
    assert "l_linenumber" in plan[scan:plan.index("\n", scan)]     # the condition stands on the columns of the scan


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    """the shuffles of a table are gone when it is written; settings are as before."""
    from pathlib import Path

    def data_files():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in local for f in Path(d).rglob("shuffle_*.data")}

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    wh, before = Warehouse(spark, bankdata.raw_tables(spark, SF_DIR), root=str(tmp_path)), data_files()
    settings_before = [spark.conf.get(n) for n in names]
    wh.table("silver_kaggle")
    left = data_files() - before
    for _ in range(20):            # files are removed by a thread of their own
        if not left:
            break
        time.sleep(0.5)
        left = data_files() - before
    assert not left and [spark.conf.get(n) for n in names] == settings_before


def test_only_labels_that_say_yes_travel(spark, rows):
    """the others are left out below the grouping, and the flags are the same."""
    labels = spark.createDataFrame([("a", True), ("a", False), ("b", False), ("c", None), ("d", True)], "transaction_id string, is_fraud boolean")
    ids = spark.createDataFrame([(c,) for c in "abcdef"], "transaction_id string")
    flagged = silver._flag_fraud(ids, labels)
    assert rows(flagged) == [("a", True), ("b", False), ("c", False), ("d", True), ("e", False), ("f", False)]
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("is_fraud#", plan.rindex("Filter"))


def test_customer_marts_shuffle_ids_instead_of_keys(spark, rows):
    """ids and keys give the same marts, also for purchases of clients that are in no dimension."""
    day = "DATE'2024-01-01'"
    stg = spark.sql(f"""SELECT concat('t', id) AS transaction_id, concat('c', id % 5) AS client_id,
        CASE WHEN id % 4 < 3 THEN concat('5', id % 4) END AS mcc, CASE WHEN id % 9 > 0 THEN CAST(id % 6 AS DOUBLE) END AS amount_mad,
        date_add({day}, CAST(id % 3 AS INT)) AS transaction_date, CAST(id % 24 AS INT) AS transaction_hour,
        id % 2 = 0 AS is_online, id % 7 = 0 AS is_fraud FROM range(200)""")
    for name in ("amount_abs", "is_chip_transaction", "is_negative_amount", "amount_bucket", "errors", "country", "currency", "_silver_loaded_at"):
        stg = stg.withColumn(name, F.lit(None).cast("string"))
    from sarraf.functions.keys import surrogate_key

    customers = spark.sql("""SELECT concat('c', id) AS client_id, 'x' AS income_segment, 'x' AS credit_tier, 'x' AS age_group, 'F' AS gender,
        'Maroc' AS country, 100.0D AS yearly_income_mad, 500 AS credit_score, 'LOW_RISK' AS debt_risk_level FROM range(1, 8)
    """).withColumn("customer_key", surrogate_key("client_id"))
    category = spark.createDataFrame([("50", "Food"), ("51", "Fuel")], "mcc_code string, category_group string").withColumn(
        "merchant_category_key", surrogate_key("mcc_code"))
    cards = spark.sql("""SELECT concat('c', id % 3) AS client_id, id = 1 AS card_on_dark_web, false AS is_expired, 1.0D AS credit_limit_mad
        FROM range(6)""").withColumn("customer_key", surrogate_key("client_id"))
    dims, ctx = {"customer": customers, "category": category}, Warehouse(spark, {}).ctx
    for computed in (True, False):
        by_id = facts.fact_card_transactions(stg, dims, ctx, ["client", "category"], computed)
        by_key = facts.fact_card_transactions(stg, dims, ctx, ["customer", "category"], computed)
        assert "client_id" in by_id.columns and "customer_key" not in by_id.columns and "client_id" not in by_key.columns
        for mart in (lambda card: gold.customer_spending_behavior(customers, card, category, ctx),
                     lambda card: gold.fraud_risk_scoring(customers, cards, card, ctx)):
            assert mart(by_id).columns == mart(by_key).columns and rows(mart(by_id)) == rows(mart(by_key))


def test_spending_of_customers_builds_no_key_before_the_shuffle(spark, tmp_path):
    """purchases are shuffled by the id of the customer; the steps of the mart are copied."""
    wh = registry.lazy_warehouse(spark, SF_DIR)
    card = wh.fact("fact_card_transactions", "client", "category")
    assert "md5" not in plan_of(gold.purchases_by_day(card)) and "Expand" not in plan_of(gold.purchases_by_day(card))
    copied = []
    stored = Warehouse(spark, bankdata.raw_tables(spark, SF_DIR), root=str(tmp_path), computed_keys=True)
    step, stored.step = stored.step, lambda frame: copied.append(frame) or step(frame)
    stored.plan("customer_spending_behavior")
    assert len(copied) == 3 and len(list((tmp_path / "steps").iterdir())) == 2     # flagged labels are removed
