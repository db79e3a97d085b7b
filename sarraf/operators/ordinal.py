"""Dense numbering of distinct ids, and the client lookup built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sarraf.functions.text import digits

_SLOT_CHARS = 3                      # leading hex digits: 4,096 slots


def dense_ordinal(ids: DataFrame, id_col: str) -> DataFrame:
    """Number distinct ids 0..n-1 in the order of (MD5 of the id, id).

    Ids are numbered inside hash slots and shifted by the size of the slots
    before.  Distinct ids spread evenly over the slots, the offsets have at
    most 4,096 rows whatever the input, and the number of an id does not depend
    on how the input is partitioned or on a task being run again.
    """
    hashed = (
        ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
        .withColumn("_hash", F.md5(F.col(id_col)))
        .withColumn("_slot", F.left("_hash", F.lit(_SLOT_CHARS)))
    )
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_slot").agg(F.count("*").alias("_n"))
        .select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_slot").orderBy("_hash", id_col)
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_slot")
        .select(id_col, (F.col("_offset") + F.col("_rank") - 1).alias("ordinal"))
    )


def with_client(df: DataFrame, pan: str, customers: DataFrame) -> DataFrame:
    """Add ``pan_num`` and ``client_id``: the digits of the PAN modulo the number of customers.

    A PAN without a positive number has no client.  The rule is a function of
    the row, so transactions join the numbered customers directly; no map of
    distinct PANs has to be built first.
    """
    known = customers.select("client_id").filter(F.col("client_id").isNotNull()).distinct()
    size = known.agg(F.count("*").alias("n")).scalar()
    index = dense_ordinal(known, "client_id")
    numbered = df.withColumn("pan_num", digits(F.col(pan))).withColumn(
        "ordinal", F.when(F.col("pan_num") > 0, F.try_mod("pan_num", size))
    )
    return numbered.join(index, "ordinal", "left").drop("ordinal")
