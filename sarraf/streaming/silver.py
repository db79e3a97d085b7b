"""Silver kept up to date from a stream, reading new rows only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from sarraf.operators.merge import merge
from sarraf.plans import silver
from sarraf.settings import RunContext
from sarraf.sources import tables
from sarraf.streaming.run import run_available

#: Number of the load that brought a silver row; a table notes its last one.
LOAD = "_load"
_NOTE = "loads"


def last_load(spark, path: str) -> int:
    return int(tables.note(spark, path, _NOTE) or 0) if tables.exists(spark, path) else 0


def load_rows(path: str, rows: DataFrame, entity: silver.Entity) -> int:
    """Merge good rows into a silver table as its next load; returns their number.

    The number is noted after the merge: a load that is repeated keeps it.
    """
    spark = rows.sparkSession
    number = last_load(spark, path) + 1
    merged = merge(
        spark, path, rows.withColumn(LOAD, F.lit(number)), entity.key, entity.partition, entity.newest, later_wins=True
    )
    if merged.rows:
        tables.put_note(spark, path, _NOTE, str(number))
    return merged.rows


def keep_silver(
    stream: DataFrame,
    entity: silver.Entity,
    path: str,
    quarantine_root: str,
    checkpoint: str,
    ctx: RunContext,
    related: Callable[[], dict[str, DataFrame]] | None = None,
    batch_name: str = "stream",
) -> int:
    """Merge each micro-batch of raw rows into a silver table and set its bad rows aside; returns the rows merged.

    ``related`` gives the tables that enrich good and bad rows alike
    (``customers``, ``labels``); it is asked in every micro-batch.  A repeated
    batch replaces its quarantine rows and merges to the same
    table, so restarting after a failure is safe.  Rows of a key with the same
    ``newest`` value are told apart by their delivery and raw columns within a
    batch; between batches the later one wins.
    """
    total = 0

    def refresh(batch: DataFrame, number: int) -> None:
        nonlocal total
        scratch = tables.scratch_dir(batch.sparkSession, "silver")
        good, bad = silver.split(entity, batch, ctx, scratch)
        others = related() if related else {}
        total += load_rows(path, silver.enriched(entity, good, **others), entity)
        set_aside = silver.enriched(entity, bad, **others)
        tables.append_quarantine(set_aside, quarantine_root, entity.name, f"{batch_name}-{number}")
        tables.remove(batch.sparkSession, scratch)

    run_available(stream, refresh, checkpoint)
    return total
