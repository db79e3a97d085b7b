"""Keyed upserts and incremental loads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sarraf.operators.dedup import first_per_key, latest_per_key
from sarraf.sources import tables


def upsert_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows replace target rows of the same key; other source rows are added.

    ``source`` must hold each key once and no NULL key.
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key is NULL or occurs twice; keys are counted in the map tasks first."""
    wrong = df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col(key).isNull() | (F.col("copies") > 1))
    found = wrong.head(1)
    if found:
        raise ValueError(f"{key} must be unique and not NULL, found {found[0][key]!r} {found[0]['copies']} times")


def high_watermark(df: DataFrame, column: str):
    """Highest value of ``column``, a single value on the driver; None if empty."""
    return df.agg(F.max(column)).first()[0]


def rows_to_load(
    staged: DataFrame, column: str, watermark: dt.date | None, lateness_days: int = 0, strict: bool = False
) -> DataFrame:
    """Staged rows an incremental run has to look at.

    The watermark goes in as a literal so that date partitions are pruned.  An
    empty target (no watermark) loads everything.  Rows of the watermark's own
    day and of ``lateness_days`` before it are read again; the keyed merge makes
    that harmless.  ``strict`` keeps only later days, dropping late rows.
    Rows without a date always load.
    """
    if watermark is None:
        return staged
    if strict:
        return staged.filter(F.col(column) > F.lit(watermark))
    oldest = watermark - dt.timedelta(days=lateness_days)
    return staged.filter((F.col(column) >= F.lit(oldest)) | F.col(column).isNull())


def without_late(
    staged: DataFrame, column: str, watermark: dt.date | None, seen: Observation, drop: bool = True
) -> DataFrame:
    """Rows of a delivery later than ``watermark``; ``seen`` counts all while they pass.

    ``seen`` gets ``delivered``, ``late`` (not later than the watermark) and
    ``undated`` (no date; they load).  An empty target has no watermark and
    takes every row.
    """
    late = F.lit(False) if watermark is None else F.coalesce(F.col(column) <= F.lit(watermark), F.lit(False))
    counted = staged.observe(
        seen, F.count(F.lit(1)).alias("delivered"), F.count_if(late).alias("late"),
        F.count_if(F.col(column).isNull()).alias("undated"),
    )
    return counted.filter(~late) if drop else counted


#: Buckets a keyed table without a partition column starts with; it keeps its number until it is re-bucketed.
BUCKETS = 32
#: Rows of a bucket above which ``rebucket`` raises the number.
BUCKET_ROWS = 4_000_000
#: Keys of a batch that are looked up as a list, by statistics and Bloom filters of the row groups; more are joined.
KEY_LIST = 1000
_NOTE = "buckets"


def with_bucket(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The bucket a key always falls into."""
    return df.withColumn(tables.BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Number of buckets noted with a table; None if it has none."""
    found = tables.note(spark, path, _NOTE)
    return int(found) if found else None


@dataclass(frozen=True)
class Merged:
    """Rows of the batch, and the partition values that were written; None stands for the whole new table."""

    rows: int
    partitions: list | None


def merge_into(spark: SparkSession, path: str, source: DataFrame, key: str, *args, **options) -> int:
    """``merge``, for its number of rows."""
    return merge(spark, path, source, key, *args, **options).rows


def holding(target: DataFrame, batch: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows of ``target`` whose key is in ``batch``, which has ``rows`` distinct keys.

    A short list goes to the scan, where row groups whose Bloom filter knows
    none of the keys are not read.  A long one is joined, after the range of
    its keys has pruned what statistics can.
    """
    if rows <= KEY_LIST:
        return target.filter(F.col(key).isin([r[0] for r in batch.select(key).collect()]))
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return target.filter(F.col(key).between(F.lit(low), F.lit(high))).join(batch.select(key), key, "left_semi")


def merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    partition: str | None = None,
    newest: str | None = None,
    buckets: int = BUCKETS,
    later_wins: bool = False,
) -> Merged:
    """Create the table at ``path`` or upsert ``source`` into it.

    Only the partitions that lose or gain rows are read and written: those
    holding a key of the source (the key may have moved to another date) and
    those of the source itself.  A table without a partition column is divided
    by the key into the number of buckets noted with it (``buckets`` when it is
    created), so a batch touches the buckets of its keys alone.
    The new content is first written next to the checkpoints and then put in
    place of the touched partitions when all of it is there: the table is never
    read and overwritten at once, a failed publish leaves it as it was, and the
    merge can be repeated.

    With ``newest`` a source row wins only if it is not older than the target
    row; of equally new rows the source row wins with ``later_wins``, else the
    other columns decide.
    """
    bucketed = partition is None
    _finish_rebucket(spark, path)
    there = tables.exists(spark, path)
    if bucketed:
        buckets = (bucket_count(spark, path) if there else None) or buckets
        source, partition = with_bucket(source, key, buckets), tables.BUCKET
    scratch = tables.scratch_dir(spark, "merge")
    staged_source, loaded = tables.stage(source, f"{scratch}/source")
    require_unique(staged_source, key)
    if loaded == 0:
        tables.remove(spark, scratch)
        return Merged(0, [])
    if not there:
        tables.write(staged_source, path, partition, key=key)
        if bucketed:
            tables.put_note(spark, path, _NOTE, str(buckets))
        tables.remove(spark, scratch)
        return Merged(loaded, None)
    target = tables.read(spark, path, with_bucket=True)
    places = staged_source.select(partition)
    if not bucketed:
        places = places.unionByName(holding(target.select(key, partition), staged_source, key, loaded).select(partition))
    # One value per touched partition: bounded by the partitions of the table.
    values = [r[0] for r in places.distinct().collect()]
    touched = target.filter(_among(partition, values))
    if newest is None:
        merged = upsert_by_key(touched, staged_source, key)
    elif later_wins:
        both = touched.withColumn(_TURN, F.lit(0)).unionByName(
            staged_source.withColumn(_TURN, F.lit(1)), allowMissingColumns=True
        )
        merged = first_per_key(both, [key], [F.col(newest).desc_nulls_last(), F.col(_TURN).desc()]).drop(_TURN)
    else:
        merged = latest_per_key(touched.unionByName(staged_source, allowMissingColumns=True), key, newest)
    result, _ = tables.stage(merged, f"{scratch}/result")
    tables.write(result, path, partition, only_touched=True, key=key)
    # Only now: a key that moved is in its new partition before its old one goes.
    _clear_emptied(result, path, partition, values)
    tables.remove(spark, scratch)
    return Merged(loaded, values)


_TURN = "_turn"


def _among(column: str, values: list):
    """Rows with one of the values, NULL among them; a filter that prunes partitions."""
    known = [v for v in values if v is not None]
    chosen = F.col(column).isin(known)
    return F.coalesce(chosen, F.lit(True)) if len(known) < len(values) else chosen


def rebucket(spark: SparkSession, path: str, key: str, bucket_rows: int = BUCKET_ROWS, buckets: int | None = None) -> int:
    """Give a bucketed table the number of buckets its rows ask for, a power of two times ``BUCKETS``; returns it.

    The table is written anew beside itself and then renamed.  A job that dies
    before the rename leaves the table as it was; one that dies between removing the
    old and renaming the new is finished by the next merge.
    """
    _finish_rebucket(spark, path)
    have = bucket_count(spark, path)
    if have is None:
        raise ValueError(f"{path} has no buckets")
    if buckets is None:
        buckets, rows = BUCKETS, tables.read(spark, path).count()
        while buckets * bucket_rows < rows:
            buckets *= 2
    if buckets == have:
        return have
    fresh = f"{path}{_FRESH}"
    tables.remove(spark, fresh)
    tables.write(with_bucket(tables.read(spark, path), key, buckets), fresh, tables.BUCKET, key=key)
    tables.put_note(spark, fresh, _NOTE, str(buckets))  # last: a copy without it is not whole
    tables.remove(spark, path)
    tables.move(spark, fresh, path)
    return buckets


_FRESH = "-rebucketed"


def _finish_rebucket(spark: SparkSession, path: str) -> None:
    fresh = f"{path}{_FRESH}"
    if not tables.exists(spark, path) and tables.exists(spark, fresh) and tables.note(spark, fresh, _NOTE):
        tables.move(spark, fresh, path)


def _clear_emptied(result: DataFrame, path: str, partition: str, touched: list) -> None:
    """Overwrite with nothing each touched partition that has no rows left."""
    left = {r[0] for r in result.select(partition).distinct().collect()}
    empty = result.drop(partition).limit(0)
    for value in touched:
        if value not in left:
            folder = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
            if tables.exists(result.sparkSession, f"{path}/{partition}={folder}"):
                empty.write.mode("overwrite").parquet(f"{path}/{partition}={folder}")


def merge_into_delta(spark: SparkSession, path: str, source: DataFrame, key: str) -> None:
    """The same upsert for a Delta table, where the Delta package is installed."""
    from delta.tables import DeltaTable

    if not DeltaTable.isDeltaTable(spark, path):
        source.write.format("delta").save(path)
        return
    (
        DeltaTable.forPath(spark, path).alias("t")
        .merge(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"))
        .whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    )
