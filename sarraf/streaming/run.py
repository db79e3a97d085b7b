"""Opening and running streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def open_files(
    spark: SparkSession, folder: str, schema: StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as they appear, found in sub-folders too."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def open_topic(spark: SparkSession, servers: str, topic: str, schema: StructType) -> DataFrame:
    """JSON messages of a Kafka topic (needs the Kafka connector on the class path)."""
    messages = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest").load()
    )
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def run_available(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process all that is there now, then stop; the next call goes on from the checkpoint.

    ``each_batch`` must give the same result when a batch is repeated.
    """
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
