"""One row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sarraf.sources import tables

_RANK = "_rank"

#: Columns that say with which delivery a row came, later ones higher.
DELIVERY = ("batch_num", "ingested_at")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row of each key under ``order``.

    The ``rank = 1`` filter lets Spark keep one row per key in every map task
    before the shuffle, so a key that owns a third of the rows still sends at
    most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, key: str, newest: str, ties: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the highest ``newest`` (NULL last) of each key.

    Of equal rows the one delivered last wins, where the input says which
    (``DELIVERY`` columns).  What is still equal is told apart by ``ties`` and
    then by every other column, all ascending, so that the winner does not
    depend on the order of arrival.
    """
    delivered = [c for c in DELIVERY if c in df.columns]
    rest = [c for c in df.columns if c not in (key, newest, *delivered, *ties)]
    order = [F.col(c).desc_nulls_last() for c in (newest, *delivered)]
    order += [F.col(c).asc_nulls_last() for c in (*ties, *rest)]
    return first_per_key(df, [key], order)


def latest_columns(df: DataFrame, key: str, newest: str, wanted: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """The ``wanted`` columns of the rows that ``latest_per_key`` keeps.

    Rows that are equal up to the last wanted column have the same wanted
    values, so the columns after it decide nothing: they are neither sorted nor
    shuffled.
    """
    first = (key, newest, *DELIVERY, *ties)
    rest = [c for c in df.columns if c not in first]
    n = max((i + 1 for i, c in enumerate(rest) if c in wanted), default=0)
    narrow = df.select([c for c in df.columns if c in (*first, *rest[:n])])
    return latest_per_key(narrow, key, newest, ties).select(*wanted)


def count_kept(
    df: DataFrame, key: str, newest: str, value_of: Callable[[DataFrame], DataFrame], ties: Sequence[str] = ()
) -> DataFrame:
    """How many of the rows that ``latest_per_key`` keeps have each value: ``value`` and ``n``.

    ``value_of`` gives ``key`` and ``value``, an int or NULL, of rows of ``df``.
    Which row a key keeps does not matter while all its rows have one value, so
    a job counts by key and value alone, without sorting.  Whole rows are read
    again and ranked only for keys with several values, if there are any.
    """
    null = F.lit(1 << 32)  # no int
    numbers = value_of(df).select(F.col(key).alias("_key"), F.coalesce(F.col("value").cast("long"), null).alias("_value"))
    per_key = numbers.groupBy("_key").agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    counts = per_key.groupBy(
        (F.col("_low") == F.col("_high")).alias("_agree"),
        F.when(F.col("_low") == F.col("_high"), F.nullif(F.col("_low"), null)).cast("int").alias("value"),
    ).agg(F.count("*").alias("n"))
    counted, _ = tables.stage(counts, tables.scratch_dir(df.sparkSession, "kept"))
    agreed = counted.filter("_agree").select("value", "n")
    if counted.filter("NOT _agree").isEmpty():
        return agreed
    disputed = per_key.filter("_low <> _high").select("_key")
    rows = df.join(disputed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    ranked = value_of(latest_per_key(rows, key, newest, ties)).groupBy("value").agg(F.count("*").alias("n"))
    return agreed.unionByName(ranked).groupBy("value").agg(F.sum("n").alias("n"))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct combinations; hash-aggregated in the map tasks first."""
    return df.select(*cols).distinct()
