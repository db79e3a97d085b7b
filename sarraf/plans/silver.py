"""Silver: typed, checked and deduplicated entities.

Each entity is given in three steps.  ``typed`` brings the raw columns to fixed
names and types, ``checks`` say which rows are bad, ``derive`` adds the rule
columns.  Rules run after deduplication, so the shuffle carries raw values only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions import fixed_values as fv, rules, text
from sarraf.operators.conform import harmonise, pick, pick_first
from sarraf.operators.dedup import DELIVERY, count_kept, latest_columns, latest_per_key
from sarraf.operators.ordinal import with_client
from sarraf.operators.quarantine import Check, bad_rows, good_rows, reason
from sarraf.settings import RunContext
from sarraf.sources import tables


#: Columns a delivery adds; they end with deduplication.
BATCH = ("batch_id", "batch_num", "ingested_at", "source_table")


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    newest: str
    typed: Callable[[DataFrame], DataFrame]
    checks: Callable[[], list[Check]]
    derive: Callable[[DataFrame, RunContext], DataFrame]
    ties: tuple[str, ...] = ()
    partition: str | None = None


def _typed(raw: DataFrame, *columns: Column) -> DataFrame:
    """Typed columns, and those of the delivery if the input has them."""
    return raw.select(*columns, *(F.col(c) for c in DELIVERY if c in raw.columns))


def build(entity: Entity, raw: DataFrame, ctx: RunContext, part: tuple[int, int] | None = None) -> DataFrame:
    """Good rows of an entity, one per key.

    ``part`` is (number, of how many): the rows of the keys that fall into that part.  A key is in one part with all its
    rows, so the parts together are the whole.
    """
    good = good_rows(entity.typed(raw), entity.checks())
    if part:
        good = good.filter(F.pmod(F.xxhash64(entity.key), F.lit(part[1])) == part[0])
    return entity.derive(latest_per_key(good, entity.key, entity.newest, entity.ties).drop(*BATCH), ctx)


def kept_counts(entity: Entity, raw: DataFrame, ctx: RunContext, value: Column) -> DataFrame:
    """How many rows ``build`` gives for each ``value``, an int made from their columns, without building them."""
    good = good_rows(entity.typed(raw), entity.checks())

    def value_of(rows: DataFrame) -> DataFrame:
        return entity.derive(rows.drop(*BATCH), ctx).select(entity.key, value.cast("int").alias("value"))

    return count_kept(good, entity.key, entity.newest, value_of, entity.ties)


def kept(entity: Entity, raw: DataFrame, *columns: str) -> DataFrame:
    """Typed columns of the rows of ``build``, for plans that need few of them and no stored table."""
    good = good_rows(entity.typed(raw), entity.checks())
    return latest_columns(good, entity.key, entity.newest, columns, entity.ties)


def quarantine(entity: Entity, raw: DataFrame, ctx: RunContext) -> DataFrame:
    """Bad rows of an entity with ``_reason``, ``_entity`` and ``_quarantined_at``."""
    return entity.derive(bad_rows(entity.typed(raw), entity.checks(), entity.name, ctx.now()).drop(*BATCH), ctx)


def enriched(
    entity: Entity, df: DataFrame, customers: DataFrame | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """Good or bad rows with what other tables add: the client instead of the PAN, the fraud flag.

    Without customers nobody is the client, without labels nothing is fraud.
    """
    if entity.name == "card_transactions":
        return _replace_pan(df, customers)
    if entity.name == "kaggle_transactions":
        return _flag_fraud(df, labels)
    return df


def split(entity: Entity, raw: DataFrame, ctx: RunContext, scratch: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, one per key; bad rows) before enrichment, from one pass over ``raw``.

    The typed rows are written below ``scratch`` once, good and bad ones in
    partitions of their own, with the reason of the bad ones.
    """
    typed = entity.typed(raw)
    judged = typed.withColumn("_reason", reason(entity.checks())).withColumn("_bad", F.col("_reason").isNotNull())
    staged, _ = tables.stage(judged, scratch, "_bad")
    good = staged.filter(~F.col("_bad")).drop("_bad", "_reason")
    bad = staged.filter("_bad").drop("_bad").withColumns({"_entity": F.lit(entity.name), "_quarantined_at": ctx.now()})
    kept = latest_per_key(good, entity.key, entity.newest, entity.ties)
    return entity.derive(kept.drop(*BATCH), ctx), entity.derive(bad.drop(*BATCH), ctx)


def _null(column: str) -> Column:
    return F.col(column).isNull()


# --- terminals ---------------------------------------------------------------

ATM_SYNONYMS = {
    "governorate": "region",
    "type": "atm_type",
    "replenished_by": "provider",
    "replenished_from": "location_type",
    "limits": "cash_limit",
    "cash_limit_mad": "cash_limit",
}
ATM_COLUMNS = {
    "terminal_id": "string", "region": "string", "atm_type": "string", "provider": "string",
    "location_type": "string", "installation_date": "string", "cash_limit": "string",
}


def _atm_typed(raw: DataFrame) -> DataFrame:
    df = harmonise(raw, ATM_SYNONYMS, ATM_COLUMNS)
    return df.withColumns(
        {
            "terminal_id": text.tidy_upper(F.col("terminal_id")),
            **{c: text.tidy(F.col(c)) for c in ("region", "atm_type", "provider", "location_type")},
            "installation_date": text.text_date(F.col("installation_date")),
            "cash_limit": F.col("cash_limit").try_cast("double"),
        }
    )


def _atm_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "is_cash_deposit_enabled": text.contains_any(F.col("atm_type"), "Deposit", "Dépôt"),
            "atm_age_years": rules.whole_years(ctx.today(), F.col("installation_date")),
            "country": F.lit(fv.COUNTRY_RAW),
            "bank_name": F.lit(fv.BANK_NAME),
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    )


ATM_MASTER = Entity(
    name="atm_master", key="terminal_id", newest="installation_date",
    typed=_atm_typed,
    checks=lambda: [("null_terminal_id", _null("terminal_id"))],
    derive=_atm_derive,
)


# --- customers ---------------------------------------------------------------

def _customers_typed(raw: DataFrame) -> DataFrame:
    whole = ("current_age", "retirement_age", "birth_year", "birth_month", "credit_score", "num_credit_cards")
    money = ("per_capita_income", "yearly_income", "total_debt")
    return _typed(
        raw,
        pick_first(raw, "client_id", "id").alias("client_id"),
        *[pick(raw, c, "int").alias(c) for c in whole],
        text.tidy_upper(pick(raw, "gender")).alias("gender"),
        text.tidy(pick(raw, "address")).alias("address"),
        pick(raw, "latitude", "double").alias("latitude"),
        pick(raw, "longitude", "double").alias("longitude"),
        *[text.clean_money(pick(raw, c)).alias(c) for c in money],
    )


def _customers_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "age_group": rules.age_group(F.col("current_age")),
            "income_segment": rules.income_segment(F.col("yearly_income")),
            "credit_tier": rules.credit_tier(F.col("credit_score")),
            "debt_to_income_ratio": rules.debt_to_income(F.col("total_debt"), F.col("yearly_income")),
            "country": F.lit(fv.COUNTRY_RAW),
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    )


CUSTOMERS = Entity(
    name="customers", key="client_id", newest="credit_score",
    typed=_customers_typed,
    checks=lambda: [("null_client_id", _null("client_id"))],
    derive=_customers_derive,
)


# --- cards -------------------------------------------------------------------

def _cards_typed(raw: DataFrame) -> DataFrame:
    """Security code and raw number do not leave this step; the number is masked."""
    return _typed(
        raw,
        pick_first(raw, "card_id", "id").alias("card_id"),
        pick(raw, "client_id").alias("client_id"),
        text.tidy_upper(pick(raw, "card_brand")).alias("card_brand"),
        text.tidy_upper(pick(raw, "card_type")).alias("card_type"),
        text.mask_number(pick(raw, "card_number")).alias("card_number_masked"),
        text.is_yes(pick(raw, "has_chip")).alias("has_chip"),
        pick(raw, "num_cards_issued", "int", 1).alias("num_cards_issued"),
        text.clean_money(pick(raw, "credit_limit")).alias("credit_limit"),
        text.month_year_date(pick(raw, "acct_open_date")).alias("acct_open_date"),
        pick(raw, "year_pin_last_changed", "int").alias("year_pin_last_changed"),
        text.is_yes(pick(raw, "card_on_dark_web")).alias("card_on_dark_web"),
        text.month_year_date(pick(raw, "expires")).alias("expires_date"),
    )


def _cards_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "is_expired": F.col("expires_date") < ctx.today(),
            "card_age_years": rules.whole_years(ctx.today(), F.col("acct_open_date")),
            "dark_web_risk": rules.dark_web_risk(F.col("card_on_dark_web")),
            "card_category": rules.card_category(F.col("card_type")),
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    )


CARDS = Entity(
    name="cards", key="card_id", newest="acct_open_date",
    typed=_cards_typed,
    checks=lambda: [("null_card_or_client_id", _null("card_id") | _null("client_id"))],
    derive=_cards_derive,
)


# --- terminal transactions by card ---------------------------------------------

def _card_txn_typed(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        text.tidy(pick(raw, "pan")).alias("pan"),
        text.tidy(pick(raw, "refnum")).alias("refnum"),
        text.tidy_upper(pick(raw, "termid")).alias("terminal_id"),
        text.text_date(pick(raw, "date")).alias("transaction_date"),
        text.clock_hour(pick(raw, "time")).alias("transaction_hour"),
        text.tidy(pick(raw, "descr")).alias("transaction_type"),
        pick(raw, "msgtype", "int", fv.MSG_DEFAULT).alias("msg_type"),
        pick(raw, "amount", "double", 0.0).alias("amount_raw"),
        pick(raw, "respcode", "int", fv.RESP_OK).alias("resp_code"),
    )


def _card_txn_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "amount_mad": F.abs("amount_raw"),
            "is_successful": F.col("resp_code") == fv.RESP_OK,
            "is_reversal": F.col("msg_type") == fv.MSG_REVERSAL,
            "is_out_of_cash": F.col("resp_code") == fv.RESP_OUT_OF_CASH,
            "is_deposit": F.col("transaction_type").isin(fv.DEPOSIT_TYPES),
            "channel": F.lit(fv.CHANNEL_ATM),
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    ).drop("amount_raw")


# The sign is checked on the raw amount: after abs() no amount is negative.
CARD_TRANSACTIONS = Entity(
    name="card_transactions", key="refnum", newest="transaction_date", partition="transaction_date",
    typed=_card_txn_typed,
    checks=lambda: [
        ("null_terminal_id", _null("terminal_id")),
        ("null_amount", _null("amount_raw")),
        ("negative_amount", F.col("amount_raw") < 0),
        ("null_refnum", _null("refnum")),
    ],
    derive=_card_txn_derive,
)


def card_transactions(raw: DataFrame, customers: DataFrame | None, ctx: RunContext) -> DataFrame:
    """Terminal transactions with the client behind the PAN; the PAN itself is dropped."""
    return _replace_pan(build(CARD_TRANSACTIONS, raw, ctx), customers)


def card_transactions_quarantine(raw: DataFrame, customers: DataFrame | None, ctx: RunContext) -> DataFrame:
    return _replace_pan(quarantine(CARD_TRANSACTIONS, raw, ctx), customers)


def _replace_pan(df: DataFrame, customers: DataFrame | None) -> DataFrame:
    if customers is None:
        return df.drop("pan").withColumn("client_id", F.lit(None).cast("string"))
    return with_client(df, "pan", customers).drop("pan", "pan_num")


def pan_customer_map(raw_card_transactions: DataFrame, customers: DataFrame, ctx: RunContext) -> DataFrame:
    """Each distinct PAN with a number, and its client."""
    pans = raw_card_transactions.select(text.tidy(pick(raw_card_transactions, "pan")).alias("pan_masked")).distinct()
    return (
        with_client(pans, "pan_masked", customers)
        .filter(F.col("pan_num") > 0)
        .select("pan_masked", "pan_num", "client_id", ctx.now().alias("_created_at"))
    )


# --- wallet transactions -------------------------------------------------------

def _wallet_typed(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        text.tidy(pick(raw, "transaction_id")).alias("transaction_id"),
        text.tidy(pick(raw, "mobile_number")).alias("mobile_number_masked"),
        text.tidy_upper(pick(raw, "term_id")).alias("terminal_id"),
        text.text_timestamp(pick(raw, "transaction_date")).alias("transaction_datetime"),
        text.tidy(pick(raw, "transaction_type")).alias("transaction_type"),
        pick(raw, "transaction_amount", "double", 0.0).alias("amount_raw"),
        text.tidy(pick(raw, "transaction_status")).alias("transaction_status"),
    )


def _wallet_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    kind = F.col("transaction_type")
    return df.withColumns(
        {
            "amount_mad": F.abs("amount_raw"),
            "transaction_date": F.to_date("transaction_datetime"),
            "transaction_hour": F.hour("transaction_datetime"),
            "is_reversal": text.contains_any(kind, "ANNULATION", "REVERSAL"),
            "is_cash_out": text.contains_any(kind, "RETRAIT", "OUT"),
            "is_successful": F.col("transaction_status").startswith("00000"),
            "channel": F.lit(fv.CHANNEL_WALLET),
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    ).drop("amount_raw")


# A missing amount is bad too; it must not fall between good and bad.  The sign is checked before abs().
WALLET_TRANSACTIONS = Entity(
    name="wallet_transactions", key="transaction_id", newest="transaction_datetime", partition="transaction_date",
    typed=_wallet_typed,
    checks=lambda: [
        ("null_amount", _null("amount_raw")),
        ("null_id_or_negative_amount", _null("transaction_id") | (F.col("amount_raw") < 0)),
    ],
    derive=_wallet_derive,
)


# --- out-of-cash events ----------------------------------------------------------

def _ooc_typed(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        text.tidy(pick(raw, "pan")).alias("pan"),
        text.tidy(pick(raw, "refnum")).alias("refnum"),
        text.tidy_upper(pick(raw, "termid")).alias("terminal_id"),
        text.text_date(pick(raw, "date")).alias("transaction_date"),
        pick(raw, "time").alias("transaction_time"),
        text.clean_money(pick(raw, "amount")).alias("attempted_amount_mad"),
        pick(raw, "respcode", "int", fv.RESP_OUT_OF_CASH).alias("resp_code"),
        F.coalesce(pick(raw, "descr"), F.lit(fv.EMPTY_ATM_REASON)).alias("failure_reason"),
    )


def _ooc_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "transaction_hour": text.clock_hour(F.col("transaction_time")),
            "is_confirmed_ooc": F.col("resp_code") == fv.RESP_OUT_OF_CASH,
            "currency": F.lit(fv.CURRENCY),
            "_silver_loaded_at": ctx.now(),
        }
    )


OUT_OF_CASH = Entity(
    name="out_of_cash", key="refnum", newest="transaction_date", partition="transaction_date",
    typed=_ooc_typed,
    checks=lambda: [
        ("null_required_field", _null("refnum") | _null("terminal_id") | _null("attempted_amount_mad"))
    ],
    derive=_ooc_derive,
)


# --- purchases -------------------------------------------------------------------

def _purchase_typed(raw: DataFrame) -> DataFrame:
    amount = "amount" if "amount" in raw.columns else "amount_mad"
    region = F.coalesce(pick(raw, "merchant_state"), pick(raw, "merchant_region"))
    when = pick(raw, "date")
    return _typed(
        raw,
        pick_first(raw, "transaction_id", "id").alias("transaction_id"),
        pick(raw, "client_id").alias("client_id"),
        pick(raw, "card_id").alias("card_id"),
        text.text_timestamp(when).alias("transaction_datetime"),
        text.text_date(when).alias("transaction_date"),
        text.clean_money(pick(raw, amount)).alias("amount_mad"),
        text.tidy(pick(raw, "use_chip")).alias("use_chip"),
        pick(raw, "merchant_id").alias("merchant_id"),
        text.tidy(pick(raw, "merchant_city")).alias("merchant_city"),
        F.trim(region).alias("merchant_region"),
        pick(raw, "zip").alias("zip"),
        pick(raw, "mcc").alias("mcc"),
        pick(raw, "errors").alias("errors"),
    )


def _purchase_derive(df: DataFrame, ctx: RunContext) -> DataFrame:
    return (
        df.withColumns(
            {
                "transaction_hour": F.hour("transaction_datetime"),
                "amount_abs": F.abs("amount_mad"),
                "is_negative_amount": F.col("amount_mad") < 0,
                "is_online": F.col("use_chip").isin(fv.ONLINE_LABELS),
                "is_chip_transaction": F.col("use_chip").isin(fv.CHIP_LABELS),
                "country": F.lit(fv.COUNTRY_RAW),
                "currency": F.lit(fv.CURRENCY),
                "_silver_loaded_at": ctx.now(),
            }
        )
        .withColumn("amount_bucket", rules.amount_bucket(F.col("amount_abs")))
        .withColumn("channel", rules.purchase_channel(F.col("is_online"), F.col("is_chip_transaction")))
    )


KAGGLE_TRANSACTIONS = Entity(
    name="kaggle_transactions", key="transaction_id", newest="transaction_datetime", partition="transaction_date",
    ties=("merchant_id", "amount_mad"),
    typed=_purchase_typed,
    checks=lambda: [("null_transaction_or_client_id", _null("transaction_id") | _null("client_id"))],
    derive=_purchase_derive,
)


def kaggle_transactions(
    raw: DataFrame, labels: DataFrame | None, ctx: RunContext, part: tuple[int, int] | None = None
) -> DataFrame:
    """Purchases with their fraud flag."""
    return _flag_fraud(build(KAGGLE_TRANSACTIONS, raw, ctx, part), labels)


def kaggle_transactions_quarantine(raw: DataFrame, labels: DataFrame | None, ctx: RunContext) -> DataFrame:
    return _flag_fraud(quarantine(KAGGLE_TRANSACTIONS, raw, ctx), labels)


def _flag_fraud(df: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Flag from the labels; FALSE where there is none.

    Labels join after deduplication: both sides are partitioned by the id, so
    the purchases are not shuffled again.  Labels that say no change nothing
    and are left out before their ids are shuffled.
    """
    if labels is None:
        return df.withColumn("is_fraud", F.lit(False))
    flags = labels.filter("is_fraud").groupBy("transaction_id").agg(F.bool_or("is_fraud").alias("is_fraud"))
    return df.join(flags, "transaction_id", "left").withColumn("is_fraud", F.coalesce("is_fraud", F.lit(False)))


ENTITIES = {
    e.name: e
    for e in (
        ATM_MASTER, CUSTOMERS, CARDS, CARD_TRANSACTIONS, WALLET_TRANSACTIONS, OUT_OF_CASH, KAGGLE_TRANSACTIONS,
    )
}
