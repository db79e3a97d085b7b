"""Row counts, column counts and freshness per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.operators.conform import union_all

LOAD_TIMES = ("_loaded_at", "_silver_loaded_at", "_bronze_loaded_at", "_created_at")


def table_health(df: DataFrame, layer: str, table: str) -> DataFrame:
    stamp = next((c for c in LOAD_TIMES if c in df.columns), None)
    latest = F.max(stamp) if stamp else F.lit(None).cast("timestamp")
    return df.agg(F.count("*").alias("n_rows"), latest.alias("latest_load")).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), "latest_load",
    )


def layer_health(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """One row per table of each layer: one aggregate per table, all in one job."""
    rows = [table_health(df, layer, name) for layer, tables in layers.items() for name, df in tables.items()]
    return union_all(rows)


def quarantine_counts(quarantined: Mapping[str, DataFrame]) -> DataFrame:
    """Bad rows per entity and reason."""
    reasons = [df.select("_entity", "_reason") for df in quarantined.values()]
    return (
        union_all(reasons)
        .groupBy(F.col("_entity").alias("entity"), F.col("_reason").alias("reason"))
        .agg(F.count("*").alias("n_rows"))
    )


def watermarks(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Latest value of a column per table."""
    return union_all(
        df.agg(F.max(column).alias("watermark")).select(F.lit(name).alias("table_name"), "watermark")
        for name, df in tables.items()
    )


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Schema, name and type of the registered tables and views."""
    rows = [(".".join(t.namespace or []), t.name, t.tableType) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_schema string, table_name string, table_type string").orderBy(
        "table_schema", "table_name"
    )
