"""Streams give what the same rows give as a batch."""

import datetime as dt


from sarraf.operators.dedup import latest_per_key
from sarraf.sources import tables
from sarraf.streaming import hourly, land, run, upsert

SCHEMA = "key string, day date, v int"


def deliver(spark, folder, data, name, schema=SCHEMA):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def test_upsert_stream_equals_batch_and_resumes(spark, tmp_path, rows):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    first = [(f"k{i % 7}", dt.date(2024, 1, 1 + i % 5), i) for i in range(40)]
    second = [(f"k{i % 9}", dt.date(2024, 1, 1 + i % 6), i) for i in range(40, 80)]
    deliver(spark, folder, first[:20], "a")
    deliver(spark, folder, first[20:], "b")

    def go():
        stream = run.open_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
        upsert.upsert_stream(stream, path, "key", "day", checkpoint, partition="day")

    for delivered, step in ((first, None), (first + second, second), (first + second, None)):
        if step:
            deliver(spark, folder, step, "c")
        go()
        batch = latest_per_key(spark.createDataFrame(delivered, SCHEMA), "key", "day")
        assert rows(tables.read(spark, path), "key", "day", "v") == rows(batch, "key", "day", "v")


def test_deleted_rows_do_not_come_back(spark, tmp_path, rows):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    schema = "key string, v int, ts int, op string"
    batches = [[("a", 1, 1, "I"), ("b", 1, 1, "I")], [("a", 2, 5, "D")], [("a", 3, 3, "U"), ("b", 2, 2, "U")]]
    for number, data in enumerate(batches):
        deliver(spark, folder, data, str(number), schema)
        stream = run.open_files(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
        upsert.apply_change_stream(stream, path, "key", "ts", checkpoint)
    assert rows(upsert.live_rows(tables.read(spark, path)), "key", "v") == [("b", 2)]


def test_hourly_stream_equals_batch(spark, tmp_path, rows):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "hours", "checkpoint"))
    schema = "channel string, event_time timestamp, amount_mad double"
    start = dt.datetime(2024, 1, 1)
    data = [(f"c{i % 2}", start + dt.timedelta(minutes=17 * i), i * 0.25) for i in range(200)]
    # Deliveries overlap in time: hours are completed by later batches.
    for part in range(4):
        deliver(spark, folder, data[part::4], str(part), schema)
    frame = spark.createDataFrame(data, schema)
    stream = run.open_files(spark, folder, frame.schema, files_per_batch=1)
    hourly.keep_hours(stream, path, f"{path}-late", checkpoint, dt.timedelta(days=10))
    shown = (*hourly.GRAIN, "transactions", "total_amount_mad")
    assert rows(hourly.hours(spark, path), *shown) == rows(hourly.hourly_totals(frame), *shown)
    assert not [n for n in tables.children(spark, f"{path}-late") if n.startswith("batch=")]


def test_late_and_timeless_rows_go_aside_and_repeats_add_nothing(spark, tmp_path, rows, monkeypatch):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "hours", "checkpoint"))
    schema = "channel string, event_time timestamp, amount_mad double"
    start = dt.datetime(2024, 1, 10)

    def moment(hours):
        return start + dt.timedelta(hours=hours)

    def go():
        stream = run.open_files(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
        hourly.keep_hours(stream, path, f"{path}-late", checkpoint, dt.timedelta(hours=5))

    deliver(spark, folder, [("a", moment(0), 1.0), ("a", moment(0.5), 2.0), ("b", None, 4.0)], "0", schema)
    go()
    deliver(spark, folder, [("a", moment(0.2), 8.0), ("a", moment(-6), 16.0), ("a", moment(30), 32.0)], "1", schema)
    write = tables.put_note

    def dies(spark, to, name, text):
        write(spark, to, name, text)
        if name == "watermark":
            raise RuntimeError("lost")

    monkeypatch.setattr(tables, "put_note", dies)
    for _ in range(2):  # the batch is written, but its checkpoint is not
        try:
            go()
        except Exception as error:
            assert "lost" in str(error)
    monkeypatch.setattr(tables, "put_note", write)
    go()
    deliver(spark, folder, [("a", moment(24.9), 64.0), ("a", moment(26), 128.0)], "2", schema)
    go()
    assert rows(hourly.hours(spark, path), *hourly.GRAIN, "transactions", "total_amount_mad") == [
        ("a", moment(0), 3, 11.0), ("a", moment(26), 1, 128.0), ("a", moment(30), 1, 32.0),
    ]
    late = tables.read(spark, f"{path}-late")
    assert rows(late, "_reason", "amount_mad", "batch") == [("late", 16.0, 1), ("late", 64.0, 2), ("no_time", 4.0, 0)]


def test_landing_stream_names_folders_by_batch(spark, tmp_path, ctx):
    folder, landing, checkpoint = (str(tmp_path / n) for n in ("in", "landing", "checkpoint"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for number in range(2):
        deliver(spark, folder, [("a", dt.date(2024, 1, 1), number)], str(number))
        land.land_stream(run.open_files(spark, folder, schema), landing, "t", checkpoint, ctx)
    assert sorted(p.name for p in (tmp_path / "landing").iterdir()) == ["t_000000_stream", "t_000001_stream"]


def test_first_arrival(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "key string, ts timestamp"
    moment = dt.datetime(2024, 1, 1)
    deliver(spark, folder, [("a", moment), ("a", moment), ("b", moment)], "0", schema)
    stream = run.open_files(spark, folder, spark.createDataFrame([], schema).schema)
    seen = []
    run.run_available(
        upsert.first_seen(stream, "key", "ts", "1 hour"), lambda b, _: seen.extend(r["key"] for r in b.collect()),
        str(tmp_path / "checkpoint"),
    )
    assert sorted(seen) == ["a", "b"]


def test_bronze_takes_new_files_only(spark, tmp_path, ctx):
    from pyspark.sql.types import StructType

    from sarraf.schemas import LANDED_COLUMNS
    from sarraf.sources import landing
    from sarraf.streaming import bronze

    folder, path, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    schema = StructType.fromDDL(f"id string, date string, extra int, {LANDED_COLUMNS}")

    def go():
        return bronze.ingest_new(spark, folder, path, checkpoint, schema, ctx, "date")

    assert go() == 0  # no folder
    (tmp_path / "landing").mkdir()
    assert go() == 0  # an empty one
    first = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "unknown")], "id string, date string")
    landing.land_batch(first, folder, "t", "b0", 0, ctx)
    assert go() == 3
    files = sorted((tmp_path / "bronze").rglob("*.parquet"))
    assert go() == 0 and sorted((tmp_path / "bronze").rglob("*.parquet")) == files
    more = spark.createDataFrame([("d", "2024-01-01", 7, 1)], "id string, date string, extra int, unnamed_in_schema int")
    landing.land_batch(more, folder, "t", "b1", 1, ctx)
    assert go() == 1
    kept = tables.read(spark, path)
    assert set(files) < set((tmp_path / "bronze").rglob("*.parquet"))
    got = {(r["id"], r["extra"], r["batch_num"], r["_load"], str(r["_day"])) for r in kept.collect()}
    assert got == {
        ("a", None, 0, 0, "2024-01-01"), ("b", None, 0, 0, "2024-01-02"), ("c", None, 0, 0, "None"), ("d", 7, 1, 1, "2024-01-01"),
    }
    assert "unnamed_in_schema" not in kept.columns and all("b0" in r[0] or "b1" in r[0] for r in kept.select("_source_file").collect())


def test_raw_schemas_fit_the_silver_entities(spark, ctx):
    from sarraf.plans import silver
    from sarraf.plans.lakehouse import SILVER
    from sarraf.schemas import BATCH_COLUMNS, RAW_SCHEMAS

    for entity, raw in SILVER.values():
        empty = spark.createDataFrame([], f"{RAW_SCHEMAS[raw]}, {BATCH_COLUMNS}")
        built = silver.build(silver.ENTITIES[entity], empty.drop("batch_id", "batch_num", "ingested_at", "source_table"), ctx)
        assert silver.ENTITIES[entity].key in built.columns and built.count() == 0


def test_silver_from_a_stream_equals_the_batch(spark, tmp_path, ctx):
    from sarraf.plans import silver
    from sarraf.streaming.silver import keep_silver

    folder, path, bad, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "bad", "checkpoint"))
    schema = "refnum string, termid string, date string, amount string, respcode int"
    data = [
        (f"r{i % 25}", None if i % 11 == 0 else f"atm{i % 4}", f"2024-01-{1 + i % 9:02d}", str(i - 3), i % 3)
        for i in range(120)
    ]
    for part in range(3):
        deliver(spark, folder, data[part::3], str(part), schema)
    raw = spark.createDataFrame(data, schema)
    entity = silver.CARD_TRANSACTIONS
    keep_silver(run.open_files(spark, folder, raw.schema, files_per_batch=1), entity, path, bad, checkpoint, ctx)
    columns = ["refnum", "terminal_id", "transaction_date", "amount_mad", "resp_code"]
    expected = silver.build(entity, raw, ctx)

    def plain(frame):
        return sorted(tuple(r) for r in frame.select(columns).collect())

    assert plain(tables.read(spark, path)) == plain(expected)
    assert tables.read(spark, f"{bad}/card_transactions").count() == silver.quarantine(entity, raw, ctx).count()
