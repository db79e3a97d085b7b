"""Results of a run, as JSON documents with an array of node results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RESULTS = (
    "results array<struct<unique_id:string, status:string, execution_time:double, "
    "failures:bigint, message:string>>"
)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Run documents, one per file, gzipped or not; a document lists the models and tests of one run."""
    return flatten_run_results(spark.read.schema(RESULTS).option("multiLine", True).json(path))


def flatten_run_results(documents: DataFrame) -> DataFrame:
    """One row per node: the parts of its id, status, duration, failures, message."""
    # explode would put a size check of the parsed array before itself, parsing the text three times.
    nodes = documents.select(F.explode_outer("results").alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    uid = F.col("unique_id")
    return nodes.select(
        F.substring_index(uid, ".", -1).alias("node_id"),
        F.substring_index(F.substring_index(uid, ".", -2), ".", 1).alias("node_name"),
        F.when(uid.contains("."), F.substring_index(uid, ".", 1)).otherwise(F.lit("unknown")).alias("type"),
        "status",
        F.round(F.coalesce("execution_time", F.lit(0.0)), 2).alias("duration"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
        F.coalesce("message", F.lit("")).alias("message"),
    )


def run_health(nodes: DataFrame) -> DataFrame:
    """Nodes, failures and time per type and status."""
    return nodes.groupBy("type", "status").agg(
        F.count("*").alias("nodes"),
        F.sum("failures").alias("failures"),
        F.sum("duration").alias("duration"),
    )
