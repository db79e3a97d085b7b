"""Streamed landing of append-only sources."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sarraf.settings import RunContext
from sarraf.sources.landing import land_batch
from sarraf.streaming.run import run_available


def land_stream(stream: DataFrame, landing: str, table: str, checkpoint: str, ctx: RunContext) -> None:
    """Write every micro-batch into a landing folder of its own.

    The folder is named after the batch number, so a batch that is repeated
    after a failure replaces its folder and no row lands twice.
    """

    def land(batch: DataFrame, number: int) -> None:
        land_batch(batch, landing, table, "stream", number, ctx)

    run_available(stream, land, checkpoint)
