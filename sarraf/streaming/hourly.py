"""Hourly totals per channel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from sarraf.sources import tables
from sarraf.streaming.run import run_available

GRAIN = ["channel", "hour_start"]
DAY = "_day"
_NOTE = "watermark"


def hourly_totals(events: DataFrame) -> DataFrame:
    """Transactions and amount per channel and hour.

    ``events`` has ``channel``, ``event_time`` and ``amount_mad``.
    """
    hour = F.date_trunc("hour", "event_time").alias("hour_start")
    return events.groupBy("channel", hour).agg(
        F.count("*").alias("transactions"), F.sum("amount_mad").alias("total_amount_mad")
    )


def keep_hours(stream: DataFrame, path: str, late_path: str, checkpoint: str, lateness: dt.timedelta) -> None:
    """Keep one row per channel and hour of a stream, and late rows in a table of their own.

    A micro-batch is summed per hour and added to the stored hours of the days it
    has rows for; other days are not read.  An hour knows the last batch
    it was given, so a batch that is repeated after a failure adds nothing twice.  Rows older
    than the newest time of the batches before, less ``lateness``, and rows
    without a time go to ``late_path`` with ``_reason``, under the number of their batch.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = tables.note(spark, path, _NOTE) if tables.exists(spark, path) else None
        seen, before, newest = known.split("|") if known else ("-1", "", "")
        if int(seen) < number:  # else the batch is repeated: what held for it is in ``before``
            before = newest
        scratch = tables.scratch_dir(spark, "hours")
        time = F.col("event_time")
        late = F.when(time.isNull(), "no_time")
        if before:
            oldest = dt.datetime.fromisoformat(before) - lateness
            late = late.when(time < F.lit(oldest.isoformat(sep=" ")).cast("timestamp"), "late")
        rows, _ = tables.stage(batch.withColumn("_reason", late), f"{scratch}/rows")
        tables.write(
            rows.filter("_reason IS NOT NULL").withColumn("batch", F.lit(number)), late_path, "batch", only_touched=True
        )
        news = hourly_totals(rows.filter("_reason IS NULL")).withColumns(
            {"_given": F.lit(None).cast("long"), DAY: F.to_date("hour_start")}
        )
        news, n = tables.stage(news, f"{scratch}/news")
        if n:
            after = news
            if tables.exists(spark, path):
                days = [r[0] for r in news.select(DAY).distinct().collect()]  # days of one micro-batch
                after = news.unionByName(tables.read(spark, path).filter(F.col(DAY).isin(days)))
            given, new = F.max("_given"), F.col("_given").isNull()
            added = F.coalesce(given, F.lit(-1)) < number

            def total(column: str):
                kept, plus = F.sum(F.when(~new, F.col(column))), F.sum(F.when(new, F.col(column)))
                return F.when(kept.isNull(), plus).when(added & plus.isNotNull(), kept + plus).otherwise(kept).alias(column)

            last = F.greatest(given, F.max(F.when(new, F.lit(number)))).cast("long").alias("_given")
            summed = after.groupBy(*GRAIN, DAY).agg(total("transactions"), total("total_amount_mad"), last)
            result, _ = tables.stage(summed, f"{scratch}/result")
            tables.write(result, path, DAY, only_touched=True)
        top = rows.agg(F.max("event_time").cast("timestamp_ntz").cast("string")).first()[0]
        now = max(x for x in (before, _iso(top)) if x is not None)
        tables.put_note(spark, path, _NOTE, f"{number}|{before}|{now}")
        tables.remove(spark, scratch)

    run_available(stream, add, checkpoint)


def _iso(text: str | None) -> str:
    return dt.datetime.fromisoformat(text).isoformat(timespec="microseconds") if text else ""


def hours(spark, path: str) -> DataFrame:
    """The stored hours."""
    return tables.read(spark, path).select(*GRAIN, "transactions", "total_amount_mad")
