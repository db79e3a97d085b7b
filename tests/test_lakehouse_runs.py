"""A lakehouse over several deliveries: only what is new is read and written, and the end equals one delivery of all."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sarraf.plans.lakehouse import DAILY_MARTS, Lakehouse
from sarraf.plans.warehouse import FACTS
from sarraf.settings import RunContext
from sarraf.sources import bankdata, landing

SF_DIR = "/root/testdata/sf0.001"
COMPARED = [("silver", "silver_card_transactions"), ("silver", "silver_kaggle")]
COMPARED += [("marts", n) for n in (*FACTS, *DAILY_MARTS, "governorate_summary", "fraud_risk_scoring")]


def business_rows(frame):
    columns = sorted(c for c in frame.columns if not c.startswith("_"))
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=repr)


def files(tmp, house, layer, table):
    root = tmp / house.root.rsplit("/", 1)[1] / layer / table
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def is_second(name):
    """Rows of the second delivery: two days of card transactions, and labels that come after their purchases."""
    if name == "raw_card_transactions":
        return F.coalesce(F.col("date").isin("2024-01-08", "2024-01-17"), F.lit(False))
    if name == "raw_fraud_labels":
        return F.col("transaction_id").endswith("-3")
    return F.lit(False)


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("runs")
    parts, whole, raw = str(tmp / "parts"), str(tmp / "whole"), bankdata.raw_tables(spark, SF_DIR)
    for name, make in raw.items():
        frame, ctx = make(), RunContext()
        landing.land_batch(frame.filter(~is_second(name)), f"{parts}/{name}", name, "b0", 0, ctx)
        landing.land_batch(frame.filter(~is_second(name)), f"{whole}/{name}", name, "b0", 0, ctx)
        landing.land_batch(frame.filter(is_second(name)), f"{whole}/{name}", name, "b1", 1, ctx)

    def run(house, landed):
        took = house.ingest(landed), house.refresh_silver("b"), house.refresh_marts()
        house.keep_history()
        return took

    house = Lakehouse(spark, str(tmp / "house"), RunContext())
    run(house, parts)
    state = {
        "tmp": tmp, "house": house,
        "files": {n: files(tmp, house, *n) for n in [*COMPARED, ("bronze", "raw_kaggle_transactions"), ("silver", "silver_wallet")]},
    }
    for name in ("raw_card_transactions", "raw_fraud_labels"):
        landing.land_batch(raw[name]().filter(is_second(name)), f"{parts}/{name}", name, "b1", 1, RunContext())
    later = Lakehouse(spark, house.root, dataclasses.replace(house.ctx, run_ts=dt.datetime(2024, 6, 2)))
    state["took"] = run(later, parts)
    state["after"] = {n: files(tmp, house, *n) for n in state["files"]}
    state["idle"] = run(Lakehouse(spark, house.root, dataclasses.replace(house.ctx, run_ts=dt.datetime(2024, 6, 3))), parts)
    other = Lakehouse(spark, str(tmp / "other"), RunContext())
    run(other, whole)
    return state | {"later": later, "other": other}


@pytest.mark.parametrize("table", COMPARED)
def test_two_deliveries_equal_one(deliveries, table):
    assert business_rows(deliveries["later"].read(*table)) == business_rows(deliveries["other"].read(*table))


def test_only_new_rows_are_taken(deliveries):
    ingested, silver, marts = deliveries["took"]
    assert {n for n, rows in ingested.items() if rows} == {"raw_card_transactions", "raw_fraud_labels"}
    assert {n for n, rows in silver.items() if rows} == {"silver_card_transactions", "silver_kaggle", "pan_customer_map_silver"}
    assert marts["fact_wallet_transactions"] == marts["fact_out_of_cash_events"] == 0
    before, after = deliveries["files"], deliveries["after"]
    for same in (("bronze", "raw_kaggle_transactions"), ("silver", "silver_wallet"), ("marts", "fact_wallet_transactions")):
        assert before[same] == after[same]


def test_marts_are_written_for_touched_days(deliveries):
    before, after = (deliveries[k][("marts", "atm_performance")] for k in ("files", "after"))
    days = {f.split("/")[0] for f in set(before.items()) ^ set(after.items())}
    # Some transactions were stored under the day before, which they leave.
    assert days == {f"transaction_date={d}" for d in (
        "2024-01-07", "2024-01-08", "2024-01-16", "2024-01-17", "__HIVE_DEFAULT_PARTITION__"
    )}
    assert len({f.split("/")[0] for f in after}) > 20


def test_an_idle_run_writes_only_dimensions(deliveries):
    ingested, silver, marts = deliveries["idle"]
    assert not any(ingested.values()) and not any(silver.values())
    assert {n for n, rows in marts.items() if rows} <= {n for n in marts if n.startswith("dim_")}


def test_late_rows_are_counted(deliveries):
    rows = deliveries["later"].late_rows().filter("fact = 'fact_atm_transactions'").collect()
    assert len(rows) == 2
    first, second = sorted(rows, key=lambda r: r.load)
    assert first.late == 0 and second.late == second.delivered > 0 and second.skipped == 0
    assert str(second.watermark) == "2024-01-30"


def test_quarantine_has_no_card_numbers(deliveries):
    house = deliveries["later"]
    bad = house.read("quarantine", "card_transactions")
    assert "pan" not in bad.columns and "client_id" in bad.columns and bad.count() > 0
    assert "is_fraud" in house.quarantined("kaggle_transactions").columns
    assert set(house.quarantined("card_transactions").columns) == set(bad.columns)


def test_strict_loads_skip_late_rows(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path / "strict"), RunContext())
    landed, raw = str(tmp_path / "landing"), bankdata.raw_tables(spark, SF_DIR)
    name = "raw_wallet_transactions"
    frame = raw[name]()
    early = F.col("transaction_date") < F.lit("2024-01-10").cast("timestamp")
    held_back = early & (F.crc32("transaction_id") % 5 == 0)
    landing.land_batch(frame.filter(early & ~held_back), f"{landed}/{name}", name, "b0", 0, RunContext())
    house.ingest(landed)
    house.refresh_silver("b0")
    assert house.refresh_marts()["fact_wallet_transactions"] > 0  # no terminals, customers or labels have landed
    landing.land_batch(frame.filter(~early | held_back), f"{landed}/{name}", name, "b1", 1, RunContext())
    house.ingest(landed)
    house.refresh_silver("b1")
    house.refresh_marts(strict=True)
    counted = house.late_rows().filter("fact = 'fact_wallet_transactions' AND skipped > 0").collect()
    stored = house.read("silver", "silver_wallet").count()
    assert len(counted) == 1 and counted[0].late == counted[0].skipped
    assert house.read("marts", "fact_wallet_transactions").count() == stored - counted[0].skipped
    assert house.read("marts", "atm_performance").count() == 0


def test_new_customers_renumber_stored_transactions(spark, tmp_path):
    raw, landed = bankdata.raw_tables(spark, SF_DIR), str(tmp_path / "landing")
    for number, part in enumerate(("id <= 100", "id > 100")):
        landing.land_batch(raw["raw_customers"]().filter(part), f"{landed}/raw_customers", "c", f"b{number}", number, RunContext())
        house = Lakehouse(spark, str(tmp_path / "house"), RunContext())
        if number == 0:
            landing.land_batch(raw["raw_card_transactions"](), f"{landed}/raw_card_transactions", "t", "b0", 0, RunContext())
        house.ingest(landed)
        house.refresh_silver(f"b{number}")
    from sarraf.plans import silver

    expected = silver.card_transactions(raw["raw_card_transactions"](), house.read("silver", "silver_customers"), house.ctx)
    got = house.read("silver", "silver_card_transactions")
    assert business_rows(got) == business_rows(expected) and house.read("silver", "silver_customers").count() > 100


def test_history_keeps_files_of_closed_rows(spark, tmp_path):
    """Closed rows are written once; a run that dies is not seen and leaves nothing behind."""
    from sarraf.operators import history
    from sarraf.sources import tables

    path, schema = str(tmp_path / "h"), "key string, v string"

    def run(name, values, fails=False):
        at = F.lit(f"2024-01-{name} 00:00:00.250000").cast("timestamp")
        snapshot = spark.createDataFrame(list(values.items()), schema)

        def step(before):
            if before is None:
                return history.open_history(snapshot, "key", at)
            return history.apply_snapshot(before, snapshot, "key", ["v"], at)

        return history.keep(spark, path, name, step)

    assert run("01", {"a": "1", "b": "1"}) == (0, 2)
    assert run("02", {"a": "2", "b": "1"}) == (1, 2)
    closed = {p: p.stat().st_mtime_ns for p in (tmp_path / "h").glob("_state=closed-*/*.parquet")}
    assert run("03", {"a": "3", "c": "1"}) == (2, 2)
    assert run("03", {"a": "9"}) == (0, 2)  # that run is done
    assert {p: p.stat().st_mtime_ns for p in closed} == closed
    write = tables.put_note
    try:
        tables.put_note = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError):
            run("04", {"a": "4"})
    finally:
        tables.put_note = write

    def rows():
        kept = history.read_kept(spark, path)
        return sorted((r.key, r.v, r.valid_from.day, r.valid_to and r.valid_to.day) for r in kept.collect())

    expected = [("a", "1", 1, 2), ("a", "2", 2, 3), ("a", "3", 3, None), ("b", "1", 1, 3), ("c", "1", 3, None)]
    assert rows() == expected
    assert run("05", {"a": "3", "c": "1"}) == (0, 2)
    assert rows() == expected
    assert not list((tmp_path / "h").glob("*04*"))
    with pytest.raises(ValueError, match="earlier"):
        run("02", {"a": "1"})
