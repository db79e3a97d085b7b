"""Applying inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sarraf.operators.dedup import first_per_key

DELETE = "D"


def last_change_per_key(feed: DataFrame, key: str, sequence: Sequence[str]) -> DataFrame:
    """The change of each key that comes last in ``sequence``."""
    return first_per_key(feed, [key], [F.col(c).desc_nulls_last() for c in sequence])


def apply_changes(target: DataFrame, feed: DataFrame, key: str, sequence: Sequence[str], op: str = "op") -> DataFrame:
    """Target after a change feed: the last change of a key decides; ``D`` removes it."""
    last = last_change_per_key(feed, key, sequence)
    kept = target.join(last.select(key), key, "left_anti")
    written = last.filter(F.col(op) != DELETE).select(*target.columns)
    return kept.unionByName(written)
