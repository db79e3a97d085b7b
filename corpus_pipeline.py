"""From raw documents to token ids, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sarraf.llm import mixing, neardup, pii, quality, tokens
from sarraf.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their template lines."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the number of tokens, with digests of the ids and of the decoded text."""
    encoded = tokens.encode(docs)
    return tokens.digests(encoded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Forest, anchors and merges have no SQL form: the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
