"""Run parameters and the Spark settings the engine expects."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class RunContext:
    """Everything a run would otherwise take from the clock or from variables.

    ``as_of`` drives ages and expiry, ``run_ts`` stamps loaded rows.  Both are
    parameters so that a re-run gives the same rows.
    """

    as_of: dt.date = dt.date(2024, 6, 1)
    run_ts: dt.datetime = dt.datetime(2024, 6, 1, 0, 0, 0)
    fraud_amount_threshold: float = 2000.0

    def today(self) -> Column:
        return F.lit(self.as_of.isoformat()).cast("date")

    def now(self) -> Column:
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


# Session settings for cluster runs.  Partition counts are left to AQE: start
# high and let it coalesce, so that partitions stay near the advisory size at
# any data volume; skewed join and rebalance partitions are split at runtime.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Session settings for a run that shuffles about ``input_bytes``."""
    partitions = max(8, -(-input_bytes // target_partition_bytes))
    return {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
