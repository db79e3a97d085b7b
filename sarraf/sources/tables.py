"""Parquet tables: read, write, stage; the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


#: Partition column of keyed tables that have no other; readers do not see it.
BUCKET = "_bucket"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share, from ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, since a machine-local folder would be lost
    with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if shared_dir.local is None:
        shared_dir.local = tempfile.mkdtemp(prefix="sarraf-")
    return shared_dir.local


shared_dir.local = None


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/sarraf/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def note(spark: SparkSession, path: str, name: str) -> str | None:
    """What was noted about a table, next to its data; readers of the table do not see it."""
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_{name}")
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_note(spark: SparkSession, path: str, name: str, text: str) -> None:
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_{name}")
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().getName() for f in found)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a name that is free."""
    source, goal = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, goal):
        raise OSError(f"cannot rename {path} to {to}")


def read(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet", with_bucket: bool = False
) -> DataFrame:
    """Table at ``path``; date partitions are discovered and pruned by Spark."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.format(fmt).load(path)
    return table if with_bucket else table.drop(BUCKET)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Table at ``path``, or no rows of that schema if there is none."""
    if exists(spark, path):
        return read(spark, path, schema)
    return spark.createDataFrame([], schema)


def write(
    df: DataFrame, path: str, partition: str | Sequence[str] | None = None, only_touched: bool = False,
    key: str | None = None, codec: str = "snappy", append: bool = False,
) -> int:
    """Write a Parquet table; returns the row count.

    With a ``key`` every row group gets a Bloom filter of its values, sized by
    their number, so that a search for some keys skips the groups without them.

    The whole table is replaced, or with ``only_touched`` just the partitions
    that ``df`` has rows for, or with ``append`` nothing.  The count is observed while writing, so it costs
    no extra run.  Rows of one partition value are brought together first (hot
    values are split again by AQE), otherwise every task would leave a file in
    every partition.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    by = [c for c in ([partition] if isinstance(partition, str) else partition or []) if c in df.columns]
    if by:
        writer = out.hint("rebalance", *by).write.partitionBy(*by)
    else:
        writer = out.write
    if key is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    writer.mode("append" if append else "overwrite").option("compression", codec).option(
        "partitionOverwriteMode", "dynamic" if only_touched else "static"
    ).parquet(path)
    rows = _observed_rows(seen)
    if by and not rows and not only_touched and not append:
        # A partitioned table without rows would have no file to tell its columns.
        empty = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in by)
        df.drop(*by).limit(0).write.mode("overwrite").parquet(f"{path}/{empty}")
    return rows


def _observed_rows(seen: Observation) -> int:
    """Observed count.  Spark drops the observation from a plan it finds empty and then has no row to give."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return 0


def observed(seen: Observation, **nothing: int) -> dict[str, int]:
    """What an observation saw; ``nothing`` where Spark found its plan empty."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return nothing


#: Compressed columns of so many bytes are read by a task that writes a step; as rows to sort they are some twenty times as long.
STEP_SPLIT = 16 << 20


@contextlib.contextmanager
def saving_disk(spark: SparkSession) -> Iterator[None]:
    """For writing large steps: tasks read less at a time, so that sorts stay in memory, and shuffle files go when the
    write ends, not when the driver next collects garbage."""
    split = min(STEP_SPLIT, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.files.maxPartitionBytes": str(split)
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stage(df: DataFrame, path: str, partition: str | None = None, codec: str = "snappy") -> tuple[DataFrame, int]:
    """Write ``df`` and go on from the written copy: later steps do not compute it again."""
    rows = write(df, path, partition, codec=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make tables visible to SQL under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def append_quarantine(df: DataFrame, root: str, entity: str, batch: str) -> int:
    """Set bad rows aside under their entity.

    Rows of the same batch replace each other, so a repeated run does not
    double them; other batches stay.
    """
    return write(df.withColumn("_batch", F.lit(batch)), f"{root}/{entity}", "_batch", only_touched=True)
