"""Slowly changing history (type 2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sarraf.functions.keys import surrogate_key
from sarraf.sources import tables

VALIDITY = ["scd_id", "updated_at", "valid_from", "valid_to"]


def row_hash(cols: Sequence[str]) -> Column:
    """Hash of the tracked columns.  Values are length-prefixed, so no two rows look alike as text."""
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _opened(rows: DataFrame, key: str, at: Column) -> DataFrame:
    return rows.withColumns(
        {"updated_at": at, "valid_from": at, "valid_to": F.lit(None).cast("timestamp")}
    ).withColumn("scd_id", surrogate_key(key, F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def open_history(snapshot: DataFrame, key: str, run_ts: Column) -> DataFrame:
    """History of a first snapshot: every row open."""
    return _opened(snapshot, key, run_ts)


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_ts: Column,
    updated_at: str | None = None,
    close_missing: bool = True,
) -> DataFrame:
    """History after one more full snapshot.

    An open row whose tracked columns differ is closed at ``run_ts`` and a new
    one opened; new keys open; keys missing from the snapshot close if
    ``close_missing``; all else stays.  With ``updated_at`` (the timestamp
    strategy) a row counts as changed when that column is later than the open
    row's ``updated_at``.  One outer join on the key does all of it, and only
    the open rows of the history take part.
    """
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())

    old = current.select(F.col(key), F.struct(*current.columns).alias("old"), row_hash(tracked).alias("old_hash"))
    new = _opened(snapshot, key, F.col(updated_at) if updated_at else run_ts).select(
        F.col(key), F.struct(*history.columns).alias("new"), row_hash(tracked).alias("new_hash")
    )
    if updated_at:
        differs = F.col("new.updated_at") > F.col("old.updated_at")
    else:
        differs = F.col("old_hash") != F.col("new_hash")
    is_new = F.col("old").isNull()
    is_gone = F.col("new").isNull()
    changed = ~is_new & ~is_gone & F.coalesce(differs, F.lit(False))
    ends = changed | (is_gone & F.lit(close_missing))

    old_row = F.when(ends, F.col("old").withField("valid_to", run_ts)).otherwise(F.col("old"))
    new_row = F.when(is_new | changed, F.col("new"))
    after = old.join(new, key, "full_outer").select(F.inline(F.array_compact(F.array(old_row, new_row))))
    return closed.unionByName(after)


#: Partition column of a stored history: ``open-`` or ``closed-`` and the run that wrote the rows.
STATE = "_state"
_NOTE = "last_run"


def keep(
    spark: SparkSession, path: str, run: str, step: Callable[[DataFrame | None], DataFrame]
) -> tuple[int, int]:
    """One run of a stored history; returns (rows closed by it, rows open after it).

    ``step`` gives the history after the run from its open rows (None at first).
    The rows a run closes get a partition named after it (``run``, names in order of
    time), which no later run reads or writes; the open rows are written anew.
    Noting the run makes both valid at once: a run that died before leaves
    partitions that readers do not see and the next run removes.  Repeating the
    last run changes nothing; an earlier one is an error.
    """
    last = tables.note(spark, path, _NOTE) if tables.exists(spark, path) else None
    if last is not None and run < last:
        raise ValueError(f"run {run} is earlier than {last}")
    if run == last:
        return 0, spark.read.parquet(f"{path}/{STATE}=open-{last}").count()
    if tables.exists(spark, path):
        for name in tables.children(spark, path):
            if name.startswith(f"{STATE}=") and not _valid(name.partition("=")[2], last):
                tables.remove(spark, f"{path}/{name}")
    before = spark.read.parquet(f"{path}/{STATE}=open-{last}") if last is not None else None
    scratch = tables.scratch_dir(spark, "history")
    after, _ = tables.stage(step(before), scratch)
    ended = F.col("valid_to").isNotNull()
    n_closed = tables.write(after.filter(ended), f"{path}/{STATE}=closed-{run}")
    if not n_closed:
        tables.remove(spark, f"{path}/{STATE}=closed-{run}")
    n_open = tables.write(after.filter(~ended), f"{path}/{STATE}=open-{run}")
    tables.put_note(spark, path, _NOTE, run)
    if last is not None:
        tables.remove(spark, f"{path}/{STATE}=open-{last}")
    tables.remove(spark, scratch)
    return n_closed, n_open


def _valid(state: str, last: str | None) -> bool:
    kind, _, run = state.partition("-")
    return last is not None and (run == last if kind == "open" else run <= last)


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a stored history, as of its last finished run."""
    last, (kind, run) = tables.note(spark, path, _NOTE), (F.substring_index(STATE, "-", 1), F.substring_index(STATE, "-", -1))
    valid = F.when(kind == "open", run == last).otherwise(run <= last)
    return tables.read(spark, path).filter(valid).drop(STATE)


def validity_ranges(versions: DataFrame, key: str, valid_from: str, bucket: Column) -> DataFrame:
    """Add ``valid_to``, the next ``valid_from`` of the same key, to a full list of versions.

    ``bucket`` must rise with ``valid_from`` (a month, say).  The next version is
    looked up inside (key, bucket); only the last row of a bucket needs the
    first ``valid_from`` of the key's next bucket, taken from a pre-aggregated
    table.  A key with a huge history is thus spread over its buckets.
    """
    bucketed = versions.withColumn("_bucket", bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy(valid_from)
    per_key = Window.partitionBy(key).orderBy("_bucket")
    following = (
        bucketed.groupBy(key, "_bucket").agg(F.min(valid_from).alias("_first"))
        .select(key, "_bucket", F.lead("_first").over(per_key).alias("_next_first"))
    )
    return (
        bucketed.withColumn("_next", F.lead(valid_from).over(inside))
        .join(following, [key, "_bucket"], "left")
        .withColumn("valid_to", F.coalesce("_next", "_next_first"))
        .drop("_bucket", "_next", "_next_first")
    )
