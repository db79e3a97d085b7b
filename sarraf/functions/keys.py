"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sarraf.functions import fixed_values as fv


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the values as text, joined with ``-``; NULL has its own text."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(fv.NULL_KEY_TEXT))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))
