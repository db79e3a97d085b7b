"""Streams kept as keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sarraf.operators.changes import DELETE, last_change_per_key
from sarraf.operators.dedup import latest_per_key
from sarraf.operators.merge import merge_into
from sarraf.streaming.run import run_available


def upsert_stream(
    stream: DataFrame, path: str, key: str, newest: str, checkpoint: str,
    ties: Sequence[str] = (), partition: str | None = None,
) -> None:
    """Keep the latest row of each key of a stream as a table.

    Only rows that are not older than the stored one replace it, so the table
    does not depend on the order of the batches and repeating a batch changes
    nothing.  Nothing is held in stream state, however long ago a key was seen.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        latest = latest_per_key(batch, key, newest, ties)
        merge_into(batch.sparkSession, path, latest, key, partition, newest)

    run_available(stream, upsert, checkpoint)


def apply_change_stream(
    feed: DataFrame, path: str, key: str, sequence: str, checkpoint: str, partition: str | None = None
) -> None:
    """Keep the last change of each key, deletions included, as a table.

    Deletions stay as marks: an older change that arrives later cannot bring a
    deleted row back.
    """

    def apply(batch: DataFrame, _: int) -> None:
        merge_into(batch.sparkSession, path, last_change_per_key(batch, key, [sequence]), key, partition, sequence)

    run_available(feed, apply, checkpoint)


def live_rows(changes: DataFrame, op: str = "op") -> DataFrame:
    """Rows that are not deleted."""
    return changes.filter(changes[op] != DELETE).drop(op)


def first_seen(stream: DataFrame, key: str, event_time: str, within: str) -> DataFrame:
    """First arrival of each key, repeats dropped while they come within a time span.

    State is bounded by the span.  Use it where repeats are exact copies that
    arrive close together; ``upsert_stream`` handles all others.
    """
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])
