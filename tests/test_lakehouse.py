"""The stored lakehouse, run by run."""

import dataclasses
import datetime as dt

import pytest

from sarraf.plans.lakehouse import MARTS, SILVER, Lakehouse
from sarraf.plans.warehouse import Warehouse
from sarraf.sources import bankdata, landing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The raw tables in their landing folders."""
    from sarraf.settings import RunContext

    root = str(tmp_path_factory.mktemp("landing"))
    for name, make in bankdata.raw_tables(spark, SF_DIR).items():
        landing.land_batch(make(), f"{root}/{name}", name, "b0", 0, RunContext())
    return root


def business_rows(frame):
    columns = sorted(c for c in frame.columns if not c.startswith("_"))
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=repr)


@pytest.fixture(scope="module")
def house(spark, landed, tmp_path_factory):
    from sarraf.settings import RunContext

    house = Lakehouse(spark, str(tmp_path_factory.mktemp("house")), RunContext())
    assert house.ingest(landed)["raw_customers"] == 150
    house.refresh_silver("b0")
    house.refresh_marts()
    house.keep_history()
    return house


@pytest.mark.parametrize("mart", ["atm_performance", "fraud_risk_scoring", "governorate_summary"])
def test_marts_equal_the_lazy_plan(spark, house, mart):
    lazy = Warehouse(spark, bankdata.raw_tables(spark, SF_DIR))
    assert business_rows(house.read("marts", mart)) == business_rows(lazy.plan(mart))


def test_second_run_changes_nothing(spark, house, landed):
    names = [("silver", n) for n in SILVER] + [("marts", n) for n in MARTS] + [("marts", "fact_card_transactions")]
    before = {n: business_rows(house.read(*n)) for n in names}
    bad = house.read("quarantine", "card_transactions").count()
    history = house.read("snapshots", "customers_snapshot").count()
    later = Lakehouse(spark, house.root, dataclasses.replace(house.ctx, run_ts=dt.datetime(2024, 6, 2)))
    later.ingest(landed)
    later.refresh_silver("b0")
    later.refresh_marts(lateness_days=2)
    later.keep_history()
    assert {n: business_rows(later.read(*n)) for n in names} == before
    assert later.read("quarantine", "card_transactions").count() == bad
    assert later.read("snapshots", "customers_snapshot").count() == history


def test_full_load_of_facts(house, monkeypatch):
    from sarraf.plans import lakehouse

    monkeypatch.setattr(lakehouse, "DIMENSIONS", [])
    monkeypatch.setattr(lakehouse, "MARTS", [])
    monkeypatch.setattr(
        lakehouse, "FACT_LOADS", {"fact_wallet_transactions": ("silver_wallet", "wallet_transaction_key")}
    )
    before = house.read("marts", "fact_wallet_transactions").count()
    assert house.refresh_marts(full=True) == {"fact_wallet_transactions": before}
    assert house.read("marts", "fact_wallet_transactions").count() == before


def test_views_and_health(spark, house):
    house.register_views()
    assert spark.sql("SELECT count(*) FROM governorate_summary").first()[0] == house.read(
        "marts", "governorate_summary"
    ).count()
    layers = {r["layer"] for r in house.health().collect()}
    assert layers == {"bronze", "silver", "marts", "quarantine"}
