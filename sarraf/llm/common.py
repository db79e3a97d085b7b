"""Helpers the text operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sarraf.sources.tables import scratch_dir

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frugal(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over a partition, after which its memory goes back to the machine.

    Python workers live on and serve other stages; what allocators keep would
    add up next to the memory of the executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written copy.

    A lost executor then costs the running tasks only, and Spark knows the size
    of what it joins next.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored copies that no later step reads."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def compact(df: DataFrame, rows: int, per_task: int = 200_000) -> DataFrame:
    """``df``, which has some ``rows`` rows, in as many tasks as they need, and 8 at least, however many partitions it has."""
    return df.coalesce(max(8, -(-rows // per_task)))


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
