"""Fraud labels: JSON objects that map a transaction id to a label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.functions.text import is_yes

_PAIR = r'"([^"]+)"\s*:\s*(?:"([^"]*)"|([A-Za-z0-9.+-]+))[\s}\]]*$'
_FILLER = r'^[\s{}\[\]]*$'


def explode_labels(objects: DataFrame, column: str) -> DataFrame:
    """One row per entry of JSON objects held as text, one object per row."""
    pairs = F.from_json(F.col(column), "map<string,string>")
    # explode would put a size check of the parsed map before itself, parsing the text three times.
    entries = objects.select(F.explode_outer(pairs).alias("transaction_id", "label"))
    return entries.filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id", F.coalesce(is_yes(F.col("label")), F.lit(False)).alias("is_fraud")
    )


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Labels from JSON lines, each line an object of any number of entries."""
    return explode_labels(spark.read.text(path), "value")


def read_label_object(spark: SparkSession, path: str) -> DataFrame:
    """Labels from one JSON object of any size, flat or below one outer key.

    The file is split at commas, so many tasks read one file and no task holds
    it whole.  A piece that is neither an entry nor brackets (a comma inside a
    label, say) fails the job instead of being lost.
    """
    pieces = spark.read.option("lineSep", ",").text(path)
    entry = F.regexp_extract("value", _PAIR, 1)
    label = F.concat(F.regexp_extract("value", _PAIR, 2), F.regexp_extract("value", _PAIR, 3))
    broken = F.raise_error(F.concat(F.lit("not a label entry: "), F.col("value"))).cast("string")
    parsed = pieces.filter(~F.col("value").rlike(_FILLER)).select(
        F.when(entry == "", broken).otherwise(entry).alias("transaction_id"),
        F.coalesce(is_yes(label), F.lit(False)).alias("is_fraud"),
    )
    return parsed
