"""Facts: staged events with the keys of their dimensions.

Dimension keys come from left joins on unique natural keys, so a join never
changes the number of rows.  The seeds and the calendar have a fixed size and
are broadcast; every other dimension grows with the data and is left to Spark,
which broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles, splitting hot keys at runtime.

``links`` names the dimensions to look up.  A mart that needs two keys asks for
two, and the joins with the large customer, card and merchant tables do not
run.  Purchases have the ``client`` among them, the id of the customer itself:
marts that count per customer shuffle it instead of a key as long as a hash.
``computed_keys`` is for loads into stored facts: keys are computed instead
of looked up, and the fact is not shuffled (``with_computed_key``).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions import text
from sarraf.functions.keys import surrogate_key
from sarraf.settings import RunContext

# dimension: (natural key in the dimension, key column, fixed size)
_DIMENSIONS = {
    "date": ("full_date", "date_key", True),
    "channel": ("channel_code", "channel_key", True),
    "error": ("error_code", "error_type_key", True),
    "atm": ("atm_id", "atm_key", False),
    "customer": ("client_id", "customer_key", False),
    "card": ("card_id", "card_key", False),
    "merchant": ("merchant_id", "merchant_key", False),
    "category": ("mcc_code", "merchant_category_key", False),
}


#: Natural keys without a dimension row up to which they are broadcast; more are joined by shuffle.
UNKNOWN_KEYS = 1_000_000
#: Up to so many of them are named in the plan of a whole fact instead.
LISTED_KEYS = 1000


def _with_keys(
    stg: DataFrame, lookups: Mapping[str, Column], dims: Mapping[str, DataFrame], links: Collection[str] | None,
    computed_keys: bool = False,
) -> DataFrame:
    wanted = list(lookups) if links is None else [name for name in lookups if name in links]
    for name in wanted:
        natural, key, fixed_size = _DIMENSIONS[name]
        if computed_keys and not fixed_size:
            stg = with_computed_key(stg, dims[name], name, lookups[name], LISTED_KEYS)
            continue
        dim = dims[name].select(F.col(natural).alias(f"_{name}"), key)
        stg = stg.join(F.broadcast(dim) if fixed_size else dim, lookups[name] == F.col(f"_{name}"), "left")
    return stg


def with_computed_key(
    fact: DataFrame, dim: DataFrame, name: str, natural_key: Column, listed: int = 0
) -> DataFrame:
    """``fact`` with the key of a dimension that grows, without shuffling the fact.

    The surrogate key is a function of the natural key, so the dimension is not
    needed to make it, only to know which natural keys it lacks.  The distinct
    keys of the fact, counted down in the map tasks, are anti-joined with the
    dimension; what is left, usually nothing, is broadcast and gets a NULL key.
    The number of those is checked: up to ``listed`` they become a list in the
    plan, above ``UNKNOWN_KEYS`` the fact is joined as a whole.  This runs a job
    over the key column of the fact.
    """
    natural, key, _ = _DIMENSIONS[name]
    known = dim.select(F.col(natural).cast("string").alias("_known"))
    asked = fact.select(natural_key.cast("string").alias("_asked")).filter(F.col("_asked").isNotNull()).distinct()
    unknown = asked.join(known, F.col("_asked") == F.col("_known"), "left_anti")
    few = [r[0] for r in unknown.limit(listed + 1).collect()] if listed else []
    if 0 < len(few) <= listed:
        return fact.withColumn(key, F.when(~natural_key.cast("string").isin(few), surrogate_key(natural_key)))
    missing = unknown.limit(UNKNOWN_KEYS + 1).count() if few or not listed else 0
    if missing > UNKNOWN_KEYS:
        return _with_keys(fact, {name: natural_key}, {name: dim}, None).drop(f"_{name}")
    computed = F.when(natural_key.isNotNull(), surrogate_key(natural_key))
    if not missing:
        return fact.withColumn(key, computed)
    marked = F.broadcast(unknown.withColumnRenamed("_asked", "_unknown"))
    joined = fact.join(marked, natural_key.cast("string") == F.col("_unknown"), "left")
    return joined.withColumn(key, F.when(F.col("_unknown").isNull(), computed)).drop("_unknown")


def _columns(wanted: list[str | Column], df: DataFrame) -> list:
    return [c for c in wanted if not isinstance(c, str) or c in df.columns]


def fact_atm_transactions(
    stg: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, links: Collection[str] | None = None,
    computed_keys: bool = False,
) -> DataFrame:
    joined = _with_keys(
        stg,
        {
            "customer": F.col("client_id"), "atm": F.col("atm_id"), "channel": F.col("channel"),
            "error": F.col("resp_code"), "date": F.col("transaction_date"),
        },
        dims, links, computed_keys,
    )
    return joined.select(
        _columns(
            [
                surrogate_key(F.col("refnum")).alias("atm_transaction_key"),
                "date_key", "customer_key", F.lit(None).cast("string").alias("card_key"),
                "atm_key", "channel_key", "error_type_key",
                *(
                    "refnum", "amount_mad", "transaction_date", "transaction_hour", "transaction_type", "msg_type",
                    "resp_code", "is_successful", "is_reversal", "is_out_of_cash", "is_deposit", "client_id",
                    "currency", "_silver_loaded_at",
                ),
                ctx.now().alias("_loaded_at"),
            ],
            joined,
        )
    )


def fact_card_transactions(
    stg: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, links: Collection[str] | None = None,
    computed_keys: bool = False,
) -> DataFrame:
    joined = _with_keys(
        stg,
        {
            "customer": F.col("client_id"), "card": F.col("card_id"), "merchant": F.col("merchant_id"),
            "category": F.col("mcc"), "channel": F.col("channel"), "error": text.error_code(F.col("errors")),
            "date": F.col("transaction_date"),
        },
        dims, links, computed_keys,
    )
    return joined.select(
        _columns(
            [
                surrogate_key(F.col("transaction_id")).alias("card_transaction_key"),
                "date_key", "customer_key", "card_key", "merchant_key", "merchant_category_key", "channel_key",
                "error_type_key",
                *(["client_id"] if links is not None and "client" in links else []),
                *(
                    "transaction_id", "amount_mad", "amount_abs", "is_fraud", "is_online", "is_chip_transaction",
                    "is_negative_amount", "amount_bucket", "transaction_date", "transaction_hour",
                ),
                F.col("mcc").alias("mcc_code"),
                *("errors", "country", "currency", "_silver_loaded_at"),
                ctx.now().alias("_loaded_at"),
            ],
            joined,
        )
    )


def fact_wallet_transactions(
    stg: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, links: Collection[str] | None = None,
    computed_keys: bool = False,
) -> DataFrame:
    joined = _with_keys(
        stg, {"atm": F.col("atm_id"), "channel": F.col("channel"), "date": F.col("transaction_date")}, dims, links,
        computed_keys,
    )
    return joined.select(
        _columns(
            [
                surrogate_key(F.col("transaction_id")).alias("wallet_transaction_key"),
                "date_key", "atm_key", "channel_key",
                *(
                    "transaction_id", "mobile_number_masked", "amount_mad", "transaction_date", "transaction_hour",
                    "transaction_type", "transaction_status", "is_reversal", "is_cash_out", "is_successful",
                    "currency", "_silver_loaded_at",
                ),
                ctx.now().alias("_loaded_at"),
            ],
            joined,
        )
    )


def fact_out_of_cash_events(
    stg: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, links: Collection[str] | None = None,
    computed_keys: bool = False,
) -> DataFrame:
    joined = _with_keys(
        stg, {"atm": F.col("atm_id"), "error": F.col("resp_code"), "date": F.col("transaction_date")}, dims, links,
        computed_keys,
    )
    return joined.select(
        _columns(
            [
                surrogate_key(F.col("refnum")).alias("out_of_cash_key"),
                "date_key", "atm_key", "error_type_key",
                *(
                    "refnum", "pan_masked", "attempted_amount_mad", "transaction_date", "transaction_hour",
                    "resp_code", "failure_reason", "is_confirmed_ooc", "currency", "_silver_loaded_at",
                ),
                ctx.now().alias("_loaded_at"),
            ],
            joined,
        )
    )
