"""Splitting rows into good and bad, with the reason."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A check is (reason, condition that makes a row bad), tried in order.
Check = tuple[str, Column]


def _is_bad(checks: Sequence[Check]) -> Column:
    return reduce(lambda a, b: a | b, (bad for _, bad in checks))


def good_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that fail no check.

    Each check is negated on its own, which keeps NOT NULL conditions in a form
    that reaches the Parquet scan.  A check on a value must come after the NULL
    check of the same value, so no row is lost between good and bad.
    """
    for _, bad in checks:
        df = df.filter(~bad)
    return df


def reason(checks: Sequence[Check]) -> Column:
    """The first check a row fails; NULL for a good row."""
    found = F
    for label, bad in checks:
        found = found.when(bad, F.lit(label))
    return found


def bad_rows(df: DataFrame, checks: Sequence[Check], entity: str, at: Column) -> DataFrame:
    """Rows that fail a check, with reason, entity and time."""
    return df.filter(_is_bad(checks)).withColumns(
        {"_reason": reason(checks), "_entity": F.lit(entity), "_quarantined_at": at}
    )
