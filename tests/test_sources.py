"""Readers and writers."""

import json

import pytest

from sarraf.functions import fixed_values as fv
from sarraf.operators import health
from sarraf.sources import labels, landing, run_results, seeds, tables


def test_label_object_is_read_in_pieces(spark, tmp_path, rows):
    given = {str(i): ("Yes" if i % 3 == 0 else "No") for i in range(5000)}
    expected = sorted((k, v == "Yes") for k, v in given.items())
    for name, content in (("flat", given), ("nested", {"target": given})):
        for indent in (None, 2):
            path = tmp_path / f"{name}{indent}.json"
            path.write_text(json.dumps(content, indent=indent))
            assert sorted(rows(labels.read_label_object(spark, str(path)))) == expected


def test_label_forms(spark, tmp_path, rows):
    path = tmp_path / "labels.json"
    path.write_text('{"a": true, "b": false, "c": 1, "d": "oui", "e": "", "f": null}')
    assert rows(labels.read_label_object(spark, str(path))) == [
        ("a", True), ("b", False), ("c", True), ("d", True), ("e", False), ("f", False)
    ]


def test_broken_label_object_fails(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text('{"a": "Yes, sure"}')
    with pytest.raises(Exception, match="not a label entry"):
        labels.read_label_object(spark, str(path)).collect()


def test_label_lines(spark, tmp_path, rows):
    path = tmp_path / "labels.jsonl"
    path.write_text('{"a": "Yes", "b": "No"}\n{"c": "Yes"}\n')
    assert rows(labels.read_label_lines(spark, str(path))) == [("a", True), ("b", False), ("c", True)]


def test_run_documents(spark, tmp_path, rows):
    (tmp_path / "run.json").write_text(json.dumps({"results": [
        {"unique_id": "model.bank.dim_atm", "status": "success", "execution_time": 1.256},
        {"unique_id": "test.bank.unique_x.ab12", "status": "fail", "failures": 3, "message": "Got 3"},
        {"unique_id": "odd", "status": "skipped"},
    ]}, indent=1))
    nodes = run_results.read_run_results(spark, str(tmp_path / "run.json"))
    assert rows(nodes, "node_id", "node_name", "type", "status", "duration", "failures", "message") == [
        ("ab12", "unique_x", "test", "fail", 0.0, 3, "Got 3"),
        ("dim_atm", "bank", "model", "success", 1.26, 0, ""),
        ("odd", "odd", "unknown", "skipped", 0.0, 0, ""),
    ]
    assert rows(run_results.run_health(nodes), "type", "failures") == [("model", 0), ("test", 3), ("unknown", 0)]


def test_seeds_from_csv_equal_seeds_from_code(spark, tmp_path, rows):
    for reader, data, schema in (
        (seeds.dim_channel, fv.CHANNELS, seeds.CHANNEL_SCHEMA),
        (seeds.dim_error_type, fv.ERROR_TYPES, seeds.ERROR_TYPE_SCHEMA),
    ):
        header = ",".join(f.split()[0] for f in schema.split(", "))
        lines = [",".join("" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r) for r in data]
        path = tmp_path / f"{reader.__name__}.csv"
        path.write_bytes(("\r\n".join([header, *lines]) + "\r\n").encode())
        assert rows(reader(spark, str(path))) == rows(reader(spark)) == sorted(data, key=repr)


def test_csv_source_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Unnamed: 0,Card Type,.,Amount\n0,Visa,,5\n")
    df = seeds.read_raw_csv(spark, str(path))
    assert df.columns == ["card_type", "amount"] and df.first().asDict() == {"card_type": "Visa", "amount": "5"}


def test_landing_to_bronze(spark, tmp_path, ctx):
    land, bronze = str(tmp_path / "land"), str(tmp_path / "bronze")
    assert landing.ingest(spark, land, bronze, ctx) == 0
    landing.land_batch(spark.createDataFrame([(1,)], ["My Id"]), land, "t", "b0", 0, ctx)
    landing.land_batch(spark.createDataFrame([(2, "x")], ["My Id", "extra"]), land, "t", "b1", 1, ctx)
    landing.land_batch(spark.createDataFrame([(2, "x")], ["My Id", "extra"]), land, "t", "b1", 1, ctx)
    assert landing.ingest(spark, land, bronze, ctx) == 2
    got = {r["my_id"]: r for r in tables.read(spark, bronze).collect()}
    assert got[1]["extra"] is None and got[2]["extra"] == "x" and got[2]["batch_num"] == 1
    assert got[1]["_source_file"].endswith(".parquet") and got[1]["_bronze_loaded_at"] == ctx.run_ts


def test_quarantine_is_kept_per_batch(spark, tmp_path):
    bad = spark.createDataFrame([("x", "reason", "cards")], "id string, _reason string, _entity string")
    for batch in ("b1", "b1", "b2"):
        assert tables.append_quarantine(bad, str(tmp_path), "cards", batch) == 1
    assert tables.append_quarantine(bad.filter("id = 'none'"), str(tmp_path), "cards", "b3") == 0
    assert tables.read(spark, f"{tmp_path}/cards").count() == 2


def test_missing_table_is_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert tables.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0


def test_rewritten_table_keeps_no_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    assert tables.write(spark.createDataFrame([(3, "b")], "v int, p string"), path, "p") == 1
    assert [tuple(r) for r in tables.read(spark, path).collect()] == [(3, "b")]


def test_health(spark, ctx):
    loaded = spark.range(3).withColumn("_loaded_at", ctx.now())
    got = {r["table_name"]: r for r in health.layer_health({"l": {"a": loaded, "b": spark.range(0)}}).collect()}
    assert (got["a"]["n_rows"], got["a"]["n_columns"], got["a"]["latest_load"]) == (3, 2, ctx.run_ts)
    assert (got["b"]["n_rows"], got["b"]["latest_load"]) == (0, None)


def test_catalog(spark):
    tables.register_views({"shown_view": spark.range(1)})
    assert "shown_view" in [r["table_name"] for r in health.catalog_tables(spark).collect()]


def test_shared_folder_comes_from_the_session(spark):
    assert tables.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
