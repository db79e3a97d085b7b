"""Bronze kept up to date from landing folders, reading new files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sarraf.functions import text
from sarraf.settings import RunContext
from sarraf.sources import tables
from sarraf.sources.landing import to_bronze
from sarraf.streaming.run import open_files, run_available

#: Number of the micro-batch a bronze row came with, and the day of the row.
LOAD = "_load"
DAY = "_day"


def ingest_new(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    schema: StructType,
    ctx: RunContext,
    event_time: str | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Append the files that landed since the last call to a bronze table; returns their rows.

    The checkpoint knows the files that were read, so a call without new files
    reads and writes nothing.  A micro-batch has a partition of its own, divided
    by the day of ``event_time`` where there is one (rows without a day have
    the NULL partition), and replaces it when it is repeated after a
    failure.  Landed columns that ``schema`` does not name are left out; missing
    ones are NULL.  A landing folder that is not there or empty gives 0 rows.
    """
    if not tables.exists(spark, landing):
        return 0
    rows = 0

    def append(batch: DataFrame, number: int) -> None:
        nonlocal rows
        if batch.isEmpty():
            return
        loaded = batch.withColumn(LOAD, F.lit(number))
        by = [LOAD]
        if event_time is not None:
            loaded = loaded.withColumn(DAY, text.text_date(F.col(event_time).cast("string")))
            by.append(DAY)
        rows += tables.write(loaded, bronze, by, only_touched=True)

    stream = open_files(spark, landing, schema, glob="*.parquet", files_per_batch=files_per_batch)
    run_available(to_bronze(stream, ctx), append, checkpoint)
    return rows


def open_bronze(spark: SparkSession, bronze: str, files_per_batch: int | None = None) -> DataFrame:
    """A bronze table as a stream of its new files."""
    reader = spark.readStream.schema(tables.read(spark, bronze).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(bronze)
