"""Landing folders and the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sarraf.operators.conform import clean_columns, drop_junk_columns
from sarraf.settings import RunContext
from sarraf.sources import tables


def stamp_batch(df: DataFrame, table: str, batch_id: str, batch_num: int, ctx: RunContext) -> DataFrame:
    """Columns that say which delivery a row came with."""
    return clean_columns(drop_junk_columns(df)).withColumns(
        {
            "_batch_id": F.lit(batch_id),
            "_batch_num": F.lit(batch_num),
            "_ingested_at": ctx.now(),
            "_source_table": F.lit(table),
        }
    )


def land_batch(df: DataFrame, landing: str, table: str, batch_id: str, batch_num: int, ctx: RunContext) -> int:
    """Write one delivery into its own folder; repeating a batch replaces it."""
    stamped = stamp_batch(df, table, batch_id, batch_num, ctx)
    return tables.write(stamped, f"{landing}/{table}_{batch_num:06d}_{batch_id}")


def scan_landing(spark: SparkSession, landing: str, schema: StructType | None = None, glob: str | None = None) -> DataFrame:
    """All Parquet files below a landing folder, columns merged by name.

    With a schema no footer is read to infer one, which matters with millions of files.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob or "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(landing)


def to_bronze(landed: DataFrame, ctx: RunContext) -> DataFrame:
    """Raw rows under clean names, with source file and load time."""
    return clean_columns(
        landed,
        F.col("_metadata.file_path").alias("_source_file"),
        ctx.now().alias("_bronze_loaded_at"),
    )


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    ctx: RunContext,
    partition: str | None = None,
    schema: StructType | None = None,
) -> int:
    """Rebuild a bronze table from its landing folder; 0 if nothing has landed."""
    if not tables.exists(spark, landing):
        return 0
    return tables.write(to_bronze(scan_landing(spark, landing, schema), ctx), bronze, partition)
