"""Data-quality checks.

All row checks of a table (missing values, value lists, ranges) are counters in
one aggregation, so a table is scanned once however many checks it has.
All uniqueness checks of a table are one scan and one pre-aggregated grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions import fixed_values as fv
from sarraf.operators.conform import union_all


@dataclass(frozen=True)
class Contract:
    """What must hold for a table.  A range is (low, high); None leaves a side open."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    values: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple] = field(default_factory=dict)


def _out_of_range(column: str, low, high) -> Column:
    sides = []
    if low is not None:
        sides.append(F.col(column) < low)
    if high is not None:
        sides.append(F.col(column) > high)
    return reduce(lambda a, b: a | b, sides)


def row_checks(contract: Contract) -> list[tuple[str, str, Column]]:
    """(kind, column, condition that makes a row fail).  NULL passes all but not_null."""
    return [
        *[("not_null", c, F.col(c).isNull()) for c in contract.not_null],
        *[("accepted_values", c, ~F.col(c).isin(list(v))) for c, v in contract.values.items()],
        *[("accepted_range", c, _out_of_range(c, *bounds)) for c, bounds in contract.ranges.items()],
    ]


def declares(contract: Contract, kinds: Sequence[str] | None = None) -> bool:
    """Whether a table has checks of these kinds."""
    return any(kinds is None or kind in kinds for kind, _, _ in row_checks(contract)) or bool(
        contract.unique and (kinds is None or "unique" in kinds)
    )


def check_rows(df: DataFrame, table: str, contract: Contract, kinds: Sequence[str] | None = None) -> DataFrame:
    """Failures per row check, found in one scan: ``table_name, test, column_name, failures``."""
    checks = [c for c in row_checks(contract) if kinds is None or c[0] in kinds]
    totals = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    # One expression text instead of hundreds of column objects: quicker to plan.
    results = ", ".join(
        f"struct('{table}' AS table_name, '{kind}' AS test, '{column}' AS column_name, c{i} AS failures)"
        for i, (kind, column, _) in enumerate(checks)
    )
    return totals.selectExpr(f"inline(array({results}))")


def check_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once per column, in the same form as the row checks.

    The table is read once: each row gives a (column, value) pair per checked
    column, pairs are counted in the map tasks before they are shuffled, and
    then again per column.
    """
    names = F.array(*[F.lit(c) for c in columns])
    pairs = df.select(F.explode(F.arrays_zip(
        names.alias("column_name"), F.array(*[F.col(c).cast("string") for c in columns]).alias("value")
    )).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    repeated = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n")).groupBy("column_name").agg(
        F.count_if(F.col("n") > 1).alias("failures")
    )
    # A column with nothing but NULL has no pairs and no failures.
    found = repeated.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "failures"))).alias("m"))
    results = ", ".join(
        f"struct('{table}' AS table_name, 'unique' AS test, '{c}' AS column_name, "
        f"coalesce(m['{c}'], 0L) AS failures)" for c in columns
    )
    return found.selectExpr(f"inline(array({results}))")


def check_tables(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], kinds: Sequence[str] | None = None
) -> DataFrame:
    """Failures of every declared check of every table."""
    parts = []
    for name, contract in contracts.items():
        if any(kinds is None or kind in kinds for kind, _, _ in row_checks(contract)):
            parts.append(check_rows(tables[name], name, contract, kinds))
        if contract.unique and (kinds is None or "unique" in kinds):
            parts.append(check_unique(tables[name], name, contract.unique))
    return union_all(parts)


# --- checks over several tables; each must return no rows ------------------------

def broken_references(fact: DataFrame, dim: DataFrame, key: str, record: str) -> DataFrame:
    """Fact rows whose key is set but not in the dimension."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti").select(
        F.col(record).alias("record_id"), F.col(key).alias(f"failing_{key}")
    )


def negative_amounts(atm: DataFrame, wallet: DataFrame) -> DataFrame:
    """Terminal and wallet amounts below zero.  Purchases may be negative: refunds."""

    def negative(fact: DataFrame, table: str, record: str) -> DataFrame:
        return fact.filter(F.col("amount_mad") < 0).select(
            F.lit(table).alias("source_table"), F.col(record).alias("record_id"),
            F.col("amount_mad").alias("failing_amount"),
        )

    return negative(atm, "fact_atm_transactions", "refnum").unionByName(
        negative(wallet, "fact_wallet_transactions", "wallet_transaction_key")
    )


def invalid_resp_codes(atm: DataFrame, ooc: DataFrame) -> DataFrame:
    """Response codes outside the valid list."""

    def invalid(fact: DataFrame, record: str, source: str) -> DataFrame:
        return fact.filter(~F.col("resp_code").isin(fv.VALID_RESP_CODES)).select(
            F.col(record).alias("record_id"), F.col("resp_code").alias("failing_resp_code"),
            F.lit(source).alias("source"),
        )

    return invalid(atm, "atm_transaction_key", "atm").unionByName(invalid(ooc, "out_of_cash_key", "ooc"))


def wallet_amounts_not_positive(wallet: DataFrame) -> DataFrame:
    """Wallet amounts of zero or less (stricter than ``negative_amounts``)."""
    return wallet.filter(F.col("amount_mad") <= 0).select(
        F.col("wallet_transaction_key").alias("record_id"), F.col("amount_mad").alias("failing_amount")
    )
