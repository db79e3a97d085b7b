"""Two-pass external shuffle into shards.

Pass 1 scatters records into memory-sized buckets by a seeded hash.  Pass 2
brings each bucket into one task, orders it by content, applies a seeded
Fisher-Yates shuffle and writes it.  The shuffled buckets, one after the other,
are the global random order; dealing it out round robin gives shards whose row
counts are at most one apart (law ``rows``), each with its slots in order.

Nothing but the sums of groups of buckets meets in one task, as many as the root of their number.  The hash covers the record,
not only its id, so neither a hot source nor a hot id lands in one bucket; only
records equal in id, source and text share a bucket.  The order depends on the records,
the seed and the number of buckets alone, so a repeated task writes the same.

Nulls are values like others; a null or empty text has size 1.  Repeated rows
each get a slot.  An empty table gives no rows.  Other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sarraf.llm.common import stored, table

SHARDS = 8
#: Text bytes of a bucket.
BUCKET_BYTES = 4 << 20


def fisher_yates(n: int, seed: tuple[int, int]) -> np.ndarray:
    """Seeded permutation of 0 .. n-1; numpy's ``permutation`` is a Fisher-Yates shuffle."""
    return np.random.default_rng(seed).permutation(n)


def _shuffle_buckets(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def flush():
            whole = pa.Table.from_batches(held)
            order = fisher_yates(whole.num_rows, (seed, current))
            place = pa.array(np.arange(whole.num_rows, dtype=np.int64))
            mixed = whole.take(pa.array(order)).append_column("_place", place)
            yield from mixed.to_batches(max_chunksize=2000)

        for batch in batches:
            buckets = batch.column("_bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and buckets[a] != current:
                    yield from flush()
                    held.clear()
                current = int(buckets[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush()

    return run


def shuffled(docs: DataFrame, n_buckets: int, seed: int) -> DataFrame:
    """``docs`` with ``_bucket`` and ``_place`` in the bucket; rows stand in that order."""
    names = [c for c in ("doc_id", "source", "text") if c in docs.columns]
    mark = F.xxhash64(F.lit(seed), *names)
    scattered = docs.withColumns({"_bucket": F.pmod(mark, F.lit(n_buckets)).cast("int"), "_mark": mark})
    dealt = scattered.repartitionById(n_buckets, F.col("_bucket")).sortWithinPartitions("_bucket", "_mark", *names).drop("_mark")
    schema = StructType([*dealt.schema.fields, StructField("_place", LongType())])
    return dealt.mapInArrow(_shuffle_buckets(seed), schema)


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """_b and _before, the rows in all buckets before it, of ``counts`` (_group, _bucket, _n); groups are runs of buckets."""
    def running(window) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_n"))
    groups = groups.select(F.col("_group").alias("_g"), running(Window.orderBy("_group")).alias("_groups_before"))
    inside = counts.withColumn("_inside", running(Window.partitionBy("_group").orderBy("_bucket")))
    return inside.join(groups, F.col("_group") == F.col("_g")).select(
        F.col("_bucket").alias("_b"), (F.col("_groups_before") + F.col("_inside")).alias("_before")
    )


def shard(
    docs: DataFrame, n_shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = 23, path: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with shard and slot; written to ``path`` or to the scratch folder.

    Clashing columns of ``docs`` called shard or slot are replaced.
    """
    plain = docs.drop("shard", "slot", "_bucket", "_place", "_mark")
    total = plain.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    n_buckets = max(n_shards, -(-total // bucket_bytes))
    buckets = stored(shuffled(plain, n_buckets, seed), "shard-buckets")
    counts = stored(
        buckets.groupBy("_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_group", F.floor(F.col("_bucket") / math.isqrt(n_buckets)).cast("long")),
        "shard-counts",
    )
    offsets = stored(bucket_offsets(counts), "shard-offsets")
    place = F.col("_before") + F.col("_place")
    dealt = buckets.join(offsets, F.col("_bucket") == F.col("_b")).withColumns(
        {"shard": (place % n_shards).cast(IntegerType()), "slot": F.floor(place / n_shards)}
    ).select(*plain.columns, "shard", "slot")
    if path is None:
        return dealt
    dealt.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


def op6_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``."""
    out = shard(table(spark, sf_dir, "documents"))
    raw = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
