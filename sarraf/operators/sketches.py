"""Distinct counts that can be added up.

A count of distinct ids per day says nothing about a month.  A sketch per day
does: sketches of any days are united without reading the rows again.  The
estimate is within ``bound`` of the truth with three standard errors; exact counts
stay the default elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Registers of a sketch, as a power of two: 4,096 of them, a few kilobytes.
LOG_REGISTERS = 12
SKETCH = "sketch"


def bound(log_registers: int = LOG_REGISTERS) -> float:
    """Three standard errors of an estimate, as a share of the truth."""
    return 3 * 1.04 / math.sqrt(1 << log_registers)


def daily_sketches(rows: DataFrame, by: Sequence[str], id_column: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """One sketch of the distinct ids per group of ``by``, built in the map tasks first; NULL ids do not count."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(id_column).cast("string"), F.lit(log_registers)).alias(SKETCH))


def united(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct ids per group of sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("estimate"))
