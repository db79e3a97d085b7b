"""Type-2 history."""

import datetime as dt

from pyspark.sql import functions as F

from sarraf.operators import history
from sarraf.plans.history import CARD_COLUMNS, CUSTOMER_COLUMNS

SCHEMA = "key string, v string, loaded timestamp"


def at(n):
    return dt.datetime(2024, 1, n)


def stamp(n):
    return F.lit(f"2024-01-{n:02d} 00:00:00").cast("timestamp")


def snapshot(spark, n, **values):
    return spark.createDataFrame([(k, v, at(n)) for k, v in values.items()], SCHEMA)


def shown(rows, frame):
    return rows(frame, "key", "v", "valid_from", "valid_to")


def test_change_new_gone_and_unchanged(spark, rows):
    first = history.open_history(snapshot(spark, 1, a="1", b="1", c="1"), "key", stamp(1))
    after = history.apply_snapshot(first, snapshot(spark, 2, a="1", b="2", d="1"), "key", ["v"], stamp(2))
    assert shown(rows, after) == [
        ("a", "1", at(1), None), ("b", "1", at(1), at(2)), ("b", "2", at(2), None),
        ("c", "1", at(1), at(2)), ("d", "1", at(2), None),
    ]
    assert after.select("scd_id").distinct().count() == 5


def test_same_snapshot_changes_nothing(spark, rows):
    first = history.open_history(snapshot(spark, 1, a="1", b=None), "key", stamp(1))
    after = history.apply_snapshot(first, snapshot(spark, 2, a="1", b=None), "key", ["v"], stamp(2))
    assert shown(rows, after) == shown(rows, first)


def test_missing_value_is_a_change(spark, rows):
    first = history.open_history(snapshot(spark, 1, a=None), "key", stamp(1))
    after = history.apply_snapshot(first, snapshot(spark, 2, a=""), "key", ["v"], stamp(2))
    assert shown(rows, after) == [("a", "", at(2), None), ("a", None, at(1), at(2))]


def test_closed_rows_stay_and_keys_come_back(spark, rows):
    h = history.open_history(snapshot(spark, 1, a="1"), "key", stamp(1))
    h = history.apply_snapshot(h, snapshot(spark, 2, b="1"), "key", ["v"], stamp(2))
    h = history.apply_snapshot(h, snapshot(spark, 3, a="1", b="1"), "key", ["v"], stamp(3))
    assert shown(rows, h) == [
        ("a", "1", at(1), at(2)), ("a", "1", at(3), None), ("b", "1", at(2), None)
    ]


def test_missing_keys_may_stay_open(spark, rows):
    first = history.open_history(snapshot(spark, 1, a="1"), "key", stamp(1))
    after = history.apply_snapshot(first, snapshot(spark, 2, b="1"), "key", ["v"], stamp(2), close_missing=False)
    assert shown(rows, after) == [("a", "1", at(1), None), ("b", "1", at(2), None)]


def test_by_load_time_every_reload_is_a_version(spark, rows):
    first = history.open_history(snapshot(spark, 1, a="1"), "key", stamp(1))
    after = history.apply_snapshot(first, snapshot(spark, 2, a="1"), "key", ["v"], stamp(3), updated_at="loaded")
    assert shown(rows, after) == [("a", "1", at(1), at(3)), ("a", "1", at(2), None)]


def test_ranges_across_buckets(spark, rows):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 4, 2), dt.date(2024, 4, 3)]
    versions = spark.createDataFrame([("k", d) for d in days] + [("other", days[1])], "key string, day date")
    got = history.validity_ranges(versions, "key", "day", F.trunc("day", "month"))
    assert rows(got, "key", "day", "valid_to") == [
        ("k", days[0], days[1]), ("k", days[1], days[2]), ("k", days[2], days[3]), ("k", days[3], None),
        ("other", days[1], None),
    ]


def test_snapshot_widths():
    assert (len(CUSTOMER_COLUMNS), len(CARD_COLUMNS)) == (21, 18)
