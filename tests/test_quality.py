"""Declared checks."""

from sarraf.operators import quality
from sarraf.operators.quality import Contract
from sarraf.plans.contracts import CONTRACTS


def test_number_of_declared_checks():
    kinds = [kind for c in CONTRACTS.values() for kind, _, _ in quality_rows(c)]
    unique = sum(len(c.unique) for c in CONTRACTS.values())
    assert (kinds.count("not_null"), unique, kinds.count("accepted_values"), kinds.count("accepted_range")) == (
        109, 30, 19, 22
    )
    assert len(CONTRACTS) == 26


def quality_rows(contract):
    return [("not_null", c, None) for c in contract.not_null] + [
        ("accepted_values", c, None) for c in contract.values
    ] + [("accepted_range", c, None) for c in contract.ranges]


def test_failures_are_counted(spark):
    df = spark.createDataFrame(
        [("a", "X", 5), ("a", "Y", -1), (None, "Z", 11), ("b", None, None)], "k string, kind string, n int"
    )
    contract = Contract(not_null=["k"], unique=["k"], values={"kind": ["X", "Y"]}, ranges={"n": (0, 10)})
    got = {(r["test"], r["column_name"]): r["failures"] for r in
           quality.check_tables({"t": df}, {"t": contract}).collect()}
    assert got == {("not_null", "k"): 1, ("unique", "k"): 1, ("accepted_values", "kind"): 1, ("accepted_range", "n"): 2}


def test_open_range(spark):
    df = spark.createDataFrame([(-1,), (10**9,)], "n int")
    got = quality.check_rows(df, "t", Contract(ranges={"n": (0, None)})).first()
    assert got["failures"] == 1


def test_checks_over_tables(spark):
    dim = spark.createDataFrame([("a1",)], "atm_key string")
    fact = spark.createDataFrame(
        [("r1", "a1", 1.0, 0), ("r2", "zz", -1.0, 7), ("r3", None, 0.0, None)],
        "refnum string, atm_key string, amount_mad double, resp_code int",
    ).withColumnRenamed("refnum", "atm_transaction_key").selectExpr(
        "*", "atm_transaction_key AS refnum", "atm_transaction_key AS wallet_transaction_key",
        "atm_transaction_key AS out_of_cash_key",
    )
    broken = quality.broken_references(fact, dim, "atm_key", "refnum").collect()
    assert [tuple(r) for r in broken] == [("r2", "zz")]
    assert quality.negative_amounts(fact, fact).count() == 2
    assert [r["source"] for r in quality.invalid_resp_codes(fact, fact).orderBy("source").collect()] == ["atm", "ooc"]
    assert sorted(r["record_id"] for r in quality.wallet_amounts_not_positive(fact).collect()) == ["r2", "r3"]


def test_accepted_values_over_purchases_written_in_parts(spark, tmp_path):
    """the tables it checks are built whole."""
    from sarraf.plans.warehouse import Warehouse
    from sarraf.sources import bankdata

    raw = bankdata.raw_tables(spark, "/root/testdata/sf0.001")
    wh = Warehouse(spark, raw, root=str(tmp_path), computed_keys=True)
    contracts = {"fact_card_transactions": CONTRACTS["fact_card_transactions"]}
    kind, fact = ["accepted_values"], wh.table("fact_card_transactions")
    assert fact.count() == Warehouse(spark, raw).plan("silver_kaggle").count()
    got = quality.check_tables({"fact_card_transactions": fact}, contracts, kind).collect()
    assert [(r["column_name"], r["failures"]) for r in got] == [("is_fraud", 0)]
