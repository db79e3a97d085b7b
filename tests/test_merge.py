"""Keyed merge, incremental loads, change feeds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sarraf.operators import changes, dedup, merge
from sarraf.sources import tables

SCHEMA = "key string, day date, v int"


def day(n):
    return dt.date(2024, 1, n)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.mark.parametrize("partition", [None, "day"])
def test_create_update_insert(spark, tmp_path, rows, partition):
    path = str(tmp_path / "t")
    assert merge.merge_into(spark, path, frame(spark, ("a", day(1), 1), ("b", day(2), 2)), "key", partition) == 2
    assert merge.merge_into(spark, path, frame(spark, ("b", day(2), 3), ("c", day(3), 4)), "key", partition) == 2
    assert rows(tables.read(spark, path), "key", "day", "v") == [("a", day(1), 1), ("b", day(2), 3), ("c", day(3), 4)]


@pytest.mark.parametrize("partition", [None, "day"])
def test_twice_is_once(spark, tmp_path, rows, partition):
    path = str(tmp_path / "t")
    merge.merge_into(spark, path, frame(spark, ("a", day(1), 1), ("b", day(2), 2)), "key", partition)
    batch = frame(spark, ("b", day(3), 3))
    merge.merge_into(spark, path, batch, "key", partition)
    once = rows(tables.read(spark, path), "key", "day", "v")
    merge.merge_into(spark, path, batch, "key", partition)
    assert rows(tables.read(spark, path), "key", "day", "v") == once


def test_key_that_moves_leaves_its_old_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    merge.merge_into(spark, path, frame(spark, ("a", day(1), 1), ("b", day(2), 2), ("c", None, 3)), "key", "day")
    merge.merge_into(spark, path, frame(spark, ("a", day(2), 9), ("c", day(5), 4)), "key", "day")
    assert rows(tables.read(spark, path), "key", "day", "v") == [("a", day(2), 9), ("b", day(2), 2), ("c", day(5), 4)]


def test_other_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    merge.merge_into(spark, str(path), frame(spark, ("a", day(1), 1), ("b", day(2), 2)), "key", "day")
    before = sorted(p.name for p in (path / "day=2024-01-01").glob("*.parquet"))
    merge.merge_into(spark, str(path), frame(spark, ("b", day(2), 3)), "key", "day")
    assert sorted(p.name for p in (path / "day=2024-01-01").glob("*.parquet")) == before


def test_repeated_and_missing_keys_are_refused(spark, tmp_path):
    for bad in (frame(spark, ("a", day(1), 1), ("a", day(1), 2)), frame(spark, (None, day(1), 1))):
        with pytest.raises(ValueError, match="unique"):
            merge.merge_into(spark, str(tmp_path / "t"), bad, "key")
    assert not tables.exists(spark, str(tmp_path / "t"))


def test_older_rows_do_not_win(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for batch in ([("a", day(5), 5)], [("a", day(3), 3), ("b", day(1), 1)], [("a", day(6), 6)]):
        merge.merge_into(spark, path, frame(spark, *batch), "key", "day", newest="day")
    assert rows(tables.read(spark, path), "key", "v") == [("a", 6), ("b", 1)]


def test_empty_batch(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    merge.merge_into(spark, path, frame(spark, ("a", day(1), 1)), "key", "day")
    assert merge.merge_into(spark, path, frame(spark, ("a", day(1), 1)).filter("v > 1"), "key", "day") == 0
    assert rows(tables.read(spark, path), "key", "v") == [("a", 1)]


@pytest.mark.parametrize("partition", [None, "day"])
def test_failed_publish_leaves_the_table_and_can_be_repeated(spark, tmp_path, rows, monkeypatch, partition):
    path = str(tmp_path / "t")
    first = frame(spark, ("a", day(1), 1), ("b", day(2), 2), ("d", day(3), 4))
    merge.merge_into(spark, path, first, "key", partition)
    batch, write = frame(spark, ("b", day(3), 3), ("c", day(3), 4)), tables.write

    def poisoned(df, to, *args, **options):
        if to == path:
            df = df.withColumn("v", F.when(F.col("key") == "c", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
        return write(df, to, *args, **options)

    monkeypatch.setattr(tables, "write", poisoned)
    with pytest.raises(Exception, match="lost"):
        merge.merge_into(spark, path, batch, "key", partition)
    monkeypatch.setattr(tables, "write", write)
    assert rows(tables.read(spark, path), "key", "v") == [("a", 1), ("b", 2), ("d", 4)]
    merge.merge_into(spark, path, batch, "key", partition)
    assert rows(tables.read(spark, path), "key", "v") == [("a", 1), ("b", 3), ("c", 4), ("d", 4)]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = tmp_path / "t"
    merge.merge_into(spark, str(path), frame(spark, *((f"k{i}", day(1), i) for i in range(200))), "key")
    before = {p.parent.name: p.name for p in path.glob("*/*.parquet")}
    merge.merge_into(spark, str(path), frame(spark, ("k7", day(2), 9)), "key")
    after = {p.parent.name: p.name for p in path.glob("*/*.parquet")}
    assert len(before) == merge.BUCKETS and sum(before[b] != after[b] for b in before) == 1


def test_scratch_is_removed(spark, tmp_path):
    import glob

    folders = tables.shared_dir(spark).removeprefix("file:") + "/sarraf/merge-*"
    before = glob.glob(folders)
    merge.merge_into(spark, str(tmp_path / "t"), frame(spark, ("a", day(1), 1)), "key")
    merge.merge_into(spark, str(tmp_path / "t"), frame(spark, ("a", day(2), 2)), "key")
    assert glob.glob(folders) == before


def test_last_delivery_wins_ties(spark, rows):
    again = spark.createDataFrame(
        [("t1", day(1), 200, 0), ("t1", day(1), 900, 1), ("t2", day(2), 5, 1), ("t2", day(1), 7, 2)],
        "key string, day date, v int, batch_num int",
    )
    assert rows(dedup.latest_per_key(again, "key", "day"), "key", "v") == [("t1", 900), ("t2", 5)]


def test_rows_to_load(spark, rows):
    staged = frame(spark, ("late", day(4), 1), ("same", day(5), 2), ("new", day(6), 3), ("undated", None, 4))

    def loaded(**options):
        return [r[0] for r in rows(merge.rows_to_load(staged, "day", day(5), **options), "key")]

    assert loaded() == ["new", "same", "undated"]
    assert loaded(lateness_days=1) == ["late", "new", "same", "undated"]
    assert loaded(strict=True) == ["new"]
    assert merge.rows_to_load(staged, "day", None).count() == 4
    assert merge.high_watermark(staged, "day") == day(6)
    assert merge.high_watermark(staged.limit(0), "day") is None


def test_change_feed(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    feed = spark.createDataFrame(
        [("a", 5, 1, "U"), ("a", 6, 2, "D"), ("b", 7, 2, "U"), ("b", 8, 1, "U"), ("c", 9, 1, "I"), ("d", 0, 1, "D")],
        "key string, v int, seq int, op string",
    )
    assert rows(changes.apply_changes(target, feed, "key", ["seq"])) == [("b", 7), ("c", 9)]


def rows_read(spark, query):
    """Rows that left the Parquet scan of a frame."""
    executed = query._jdf.queryExecution()
    query._jdf.collectToPython()
    plan, found = [executed.executedPlan()], []
    while plan:
        node = plan.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_row_groups_without_the_keys_are_not_read(spark, tmp_path):
    """Hashed keys defeat minimum and maximum: only the Bloom filters tell which of 20 files to read."""
    path = str(tmp_path / "t")
    ids = spark.range(20_000).select(
        F.md5(F.col("id").cast("string")).alias("key"), F.date_add(F.lit(day(1)), (F.col("id") % 20).cast("int")).alias("day"),
        F.col("id").cast("int").alias("v"),
    )
    merge.merge_into(spark, path, ids, "key", "day")
    batch = ids.filter("v IN (5, 25)").withColumn("v", F.lit(-1))
    found = merge.holding(tables.read(spark, path), batch, "key", 2)
    assert rows_read(spark, found) <= 3000 and found.count() == 2
    many = merge.holding(tables.read(spark, path), ids.filter("v < 2000"), "key", 2000)
    assert many.count() == 2000
    merge.merge_into(spark, path, batch, "key", "day")
    after = tables.read(spark, path)
    assert after.count() == 20_000 and after.filter("v = -1").count() == 2


def test_a_table_keeps_its_number_of_buckets(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    data = [(f"k{i}", day(1), i) for i in range(20)]
    merge.merge_into(spark, path, frame(spark, *data), "key")
    merge.merge_into(spark, path, frame(spark, *((k, d, v + 100) for k, d, v in data), ("new", day(2), 0)), "key", buckets=7)
    assert merge.bucket_count(spark, path) == merge.BUCKETS
    assert rows(tables.read(spark, path), "key", "v") == sorted([*((k, v + 100) for k, _, v in data), ("new", 0)])


def test_rebucket_keeps_rows_and_later_merges_right(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    data = [(f"k{i}", day(1), i) for i in range(200)]
    merge.merge_into(spark, path, frame(spark, *data), "key", buckets=4)
    assert merge.rebucket(spark, path, "key", bucket_rows=2) == 128
    assert merge.rebucket(spark, path, "key", bucket_rows=2) == 128
    merge.merge_into(spark, path, frame(spark, ("k7", day(2), -7), ("z", day(2), 1)), "key", buckets=4)
    assert rows(tables.read(spark, path), "key", "v") == sorted([*((k, v) for k, _, v in data if k != "k7"), ("k7", -7), ("z", 1)])
    # A job that died between removing the old table and renaming the new one.
    tables.move(spark, path, f"{path}-rebucketed")
    merge.merge_into(spark, path, frame(spark, ("z", day(3), 2)), "key")
    assert tables.read(spark, path).count() == 201 and merge.bucket_count(spark, path) == 128
    with pytest.raises(ValueError, match="no buckets"):
        merge.rebucket(spark, str(tmp_path / "none"), "key")


def test_later_row_wins_ties(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for batch in ([("a", day(5), 9)], [("a", day(5), 3), ("b", day(1), 1)], [("a", day(4), 7)]):
        merge.merge_into(spark, path, frame(spark, *batch), "key", newest="day", later_wins=True)
    assert rows(tables.read(spark, path), "key", "v") == [("a", 3), ("b", 1)]


def test_merge_tells_what_it_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge.merge(spark, path, frame(spark, ("a", day(1), 1), ("b", day(2), 2)), "key", "day").partitions is None
    done = merge.merge(spark, path, frame(spark, ("a", day(3), 1)), "key", "day")
    assert (done.rows, sorted(done.partitions)) == (1, [day(1), day(3)])


def test_late_rows_are_counted_and_left_out(spark, rows):
    from pyspark.sql import Observation

    staged = frame(spark, ("late", day(4), 1), ("same", day(5), 2), ("new", day(6), 3), ("undated", None, 4))
    for watermark, kept, late in ((day(5), ["new", "undated"], 2), (None, ["late", "new", "same", "undated"], 0)):
        seen = Observation()
        assert [r[0] for r in rows(merge.without_late(staged, "day", watermark, seen), "key")] == kept
        assert seen.get == {"delivered": 4, "late": late, "undated": 1}
