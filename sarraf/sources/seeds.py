"""Seed tables of fixed size, and CSV in general."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.functions import fixed_values as fv
from sarraf.operators.conform import clean_columns, drop_junk_columns

CHANNEL_SCHEMA = (
    "channel_key int, channel_code string, channel_name string, channel_description string, "
    "is_digital boolean, is_atm boolean"
)
ERROR_TYPE_SCHEMA = (
    "error_type_key int, error_code int, error_description string, error_category string, "
    "is_fraud_related boolean, is_atm_related boolean"
)


def _fixed_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A local relation: planned with its exact size, read without a task."""
    names = [field.split()[0] for field in schema.split(", ")]
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, row)) for row in rows])).select(
        *[F.col(field.split()[0]).cast(field.split()[1]) for field in schema.split(", ")]
    )


def dim_channel(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The five channels, from code or from a CSV file."""
    if path:
        return spark.read.schema(CHANNEL_SCHEMA).option("header", True).csv(path)
    return _fixed_table(spark, fv.CHANNELS, CHANNEL_SCHEMA)


def dim_error_type(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The ten error types; the last has no code."""
    if path:
        return spark.read.schema(ERROR_TYPE_SCHEMA).option("header", True).csv(path)
    return _fixed_table(spark, fv.ERROR_TYPES, ERROR_TYPE_SCHEMA)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Source CSV, all text: typing belongs to the silver layer and no inference pass is made."""
    return clean_columns(drop_junk_columns(spark.read.option("header", True).csv(path)))
