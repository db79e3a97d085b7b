"""Marts.  Facts are aggregated to the grain of the mart before any join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions import rules
from sarraf.settings import RunContext

_BY_DAY = ["atm_key", "transaction_date"]

#: What a mart does with its steps that shuffle much: a warehouse with a folder copies them, so that not all shuffles are on disk at once.
Step = Callable[[DataFrame], DataFrame]


def _as_it_is(step: DataFrame) -> DataFrame:
    return step


def _or_zero(*columns: str) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), F.lit(0)) for c in columns}


def _pct(part: str, whole: Column | str) -> Column:
    whole = F.col(whole) if isinstance(whole, str) else whole
    return rules.ratio_pct(F.col(part), F.when(whole != 0, whole))


def atm_performance(
    dim_atm: DataFrame, atm: DataFrame, ooc: DataFrame, wallet: DataFrame, ctx: RunContext,
    full_calendar: bool = False,
) -> DataFrame:
    """Terminal and day, graded A to D.

    Days come from the card transactions: out-of-cash and wallet rows of other
    days are not shown, and a terminal without card transactions has one row
    without a date.  ``full_calendar`` takes the days of all three facts.
    """
    card_days = atm.groupBy(_BY_DAY).agg(
        F.count("*").alias("card_transactions"),
        rules.count_if(F.col("is_successful")).alias("successful_card_txns"),
        rules.count_if(F.col("is_reversal")).alias("reversals"),
        rules.count_if(F.col("is_deposit")).alias("deposits"),
        F.sum("amount_mad").alias("card_amount_mad"),
        F.avg("amount_mad").alias("avg_card_amount_mad"),
    )
    ooc_days = ooc.groupBy(_BY_DAY).agg(
        F.count("*").alias("ooc_events"), F.sum("attempted_amount_mad").alias("attempted_amount_mad")
    )
    wallet_days = wallet.groupBy(_BY_DAY).agg(
        F.count("*").alias("wallet_transactions"), F.sum("amount_mad").alias("wallet_amount_mad")
    )
    measures = [c for part in (card_days, ooc_days, wallet_days) for c in part.columns if c not in _BY_DAY]
    terminals = dim_atm.select(
        "atm_key", "atm_id", "region", "atm_type", "provider", "cash_limit_mad", "is_cash_deposit_enabled",
        "capacity_tier",
    )
    if full_calendar:
        days = card_days.unionByName(ooc_days, allowMissingColumns=True).unionByName(
            wallet_days, allowMissingColumns=True
        ).groupBy(_BY_DAY).agg(*[F.max(c).alias(c) for c in measures])
        combined = terminals.join(days, "atm_key", "left")
    else:
        combined = (
            terminals.join(card_days, "atm_key", "left")
            .join(ooc_days, _BY_DAY, "left").join(wallet_days, _BY_DAY, "left")
        )
    success = _pct("successful_card_txns", "card_transactions")
    return combined.withColumns(_or_zero(*measures)).withColumns(
        {
            "success_rate_pct": rules.round_to(success, 2),
            "total_transactions": F.col("card_transactions") + F.col("wallet_transactions"),
            "total_amount_mad": F.col("card_amount_mad") + F.col("wallet_amount_mad"),
            "performance_grade": rules.performance_grade(F.col("ooc_events"), success),
            "_loaded_at": ctx.now(),
        }
    )


def replenishment_analysis(dim_atm: DataFrame, atm: DataFrame, ooc: DataFrame, ctx: RunContext) -> DataFrame:
    """Terminal and dispensing day: cash use against the limit, and how urgent refilling is."""
    empty_days = ooc.groupBy(_BY_DAY).agg(
        F.count("*").alias("ooc_events"),
        F.sum("attempted_amount_mad").alias("attempted_after_empty_mad"),
        F.min("transaction_hour").alias("first_ooc_hour"),
    )
    paid_out = F.col("is_successful") & ~F.col("is_deposit")
    dispensed = atm.filter(paid_out).groupBy(_BY_DAY).agg(
        F.sum("amount_mad").alias("dispensed_mad"), F.count("*").alias("card_transactions")
    )
    combined = (
        dim_atm.select("atm_key", "atm_id", "region", "atm_type", "provider", "cash_limit_mad", "capacity_tier")
        .join(dispensed, "atm_key", "left")
        .join(empty_days, _BY_DAY, "left")
        .withColumnRenamed("transaction_date", "activity_date")
        .withColumns(_or_zero("dispensed_mad", "card_transactions", "ooc_events", "attempted_after_empty_mad"))
    )
    used = _pct("dispensed_mad", "cash_limit_mad")
    return combined.withColumns(
        {
            "cash_utilization_pct": rules.round_to(used, 2),
            "ran_out_of_cash": F.col("ooc_events") > 0,
            "replenishment_urgency": rules.replenishment_urgency(F.col("ooc_events")),
            "replenishment_status": rules.replenishment_status(used),
            "_loaded_at": ctx.now(),
        }
    )


def channel_comparison(
    dim_channel: DataFrame, atm: DataFrame, wallet: DataFrame, card: DataFrame, ctx: RunContext,
    literal_success: bool = False,
) -> DataFrame:
    """Channel, day and hour.

    Successful means ``is_successful`` for terminals and wallets; purchases have
    no such flag and all count.  ``literal_success`` counts every row of every
    channel, which makes all rates 100.
    """
    everything, nothing = F.count("*"), F.lit(0).cast("bigint")

    def hours(fact: DataFrame, successful: Column, reversals: Column, deposits: Column) -> DataFrame:
        return fact.groupBy("channel_key", "transaction_date", "transaction_hour").agg(
            F.count("*").alias("transactions"),
            F.sum("amount_mad").alias("total_amount_mad"),
            F.avg("amount_mad").alias("avg_amount_mad"),
            (everything if literal_success else successful).alias("successful_txns"),
            reversals.alias("reversals"),
            deposits.alias("deposits"),
        )

    flagged = rules.count_if(F.col("is_successful"))
    reversed_ = rules.count_if(F.col("is_reversal"))
    combined = (
        hours(atm, flagged, reversed_, rules.count_if(F.col("is_deposit")))
        .unionByName(hours(wallet, flagged, reversed_, nothing))
        .unionByName(hours(card, everything, nothing, nothing))
    )
    return combined.join(
        F.broadcast(dim_channel.select("channel_key", "channel_code")), "channel_key", "left"
    ).withColumns(
        {
            "success_rate_pct": rules.round_to(_pct("successful_txns", "transactions"), 2),
            "time_of_day": rules.time_of_day(F.col("transaction_hour")),
            "_loaded_at": ctx.now(),
        }
    )


def _customer(card: DataFrame) -> str:
    """What tells customers apart: their id if the purchases have it, else the key, which is longer and as good as random."""
    return "client_id" if "client_id" in card.columns else "customer_key"


def purchases_by_day(card: DataFrame, literal_night: bool = False) -> DataFrame:
    """Purchases per customer and day.

    A customer with a huge number of purchases shrinks to one row per day, in
    the map tasks already.  Active days are then a plain count of rows, with no
    distinct count over single purchases.
    """
    hour = F.col("transaction_hour")
    return card.groupBy(_customer(card), "transaction_date").agg(
        F.count("*").alias("n"),
        F.sum("amount_mad").alias("spend"),
        F.count("amount_mad").alias("amounts"),
        F.max("amount_mad").alias("most"),
        rules.count_if(rules.in_morning(hour)).alias("morning"),
        rules.count_if(rules.in_afternoon(hour)).alias("afternoon"),
        rules.count_if(rules.in_evening(hour)).alias("evening"),
        rules.count_if(rules.in_night(hour, literal_night)).alias("night"),
        rules.count_if(F.col("is_online")).alias("online"),
        rules.count_if(F.col("is_fraud")).alias("fraud"),
    )


def top_category(card: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Category group each customer spends most on, and the number of categories used.

    Equal sums are decided by name.  Purchases are summed per customer and
    category before anything else, so ranking sees a few rows per customer.
    """
    groups, who = dim_category.select("merchant_category_key", "category_group"), _customer(card)
    spent = (
        card.groupBy(who, "merchant_category_key").agg(F.sum("amount_mad").alias("spend"))
        .join(groups, "merchant_category_key", "left")
        .groupBy(who, "category_group")
        .agg(F.sum("spend").alias("spend"), F.count("merchant_category_key").alias("categories"))
    )
    name, total = F.col("category_group"), F.col("spend")
    rank = F.struct(total.isNull(), -total, name.isNull(), name)        # most spent first, then by name
    return spent.groupBy(who).agg(
        F.min_by(name, rank).alias("preferred_category"),
        F.min_by(total, rank).alias("category_spend"),
        F.sum("categories").alias("unique_categories"),
    )


def customer_spending_behavior(
    dim_customer: DataFrame, card: DataFrame, dim_category: DataFrame, ctx: RunContext, literal_night: bool = False,
    step: Step = _as_it_is,
) -> DataFrame:
    """Customer: how much, when, how, on what.

    ``literal_night`` counts night purchases over the empty hour range 23..5.
    """
    who = _customer(card)
    spending = step(purchases_by_day(card, literal_night).groupBy(who).agg(
        F.sum("n").alias("total_transactions"),
        F.sum("spend").alias("total_spend_mad"),
        F.try_divide(F.sum("spend"), F.sum("amounts")).alias("avg_spend_mad"),
        F.max("most").alias("max_spend_mad"),
        F.sum("morning").alias("morning_txns"),
        F.sum("afternoon").alias("afternoon_txns"),
        F.sum("evening").alias("evening_txns"),
        F.sum("night").alias("night_txns"),
        F.sum("online").alias("online_txns"),
        F.sum("fraud").alias("fraud_txns"),
        F.count("transaction_date").alias("active_days"),
    ))
    measures = [c for c in spending.columns if c != who] + ["unique_categories"]
    customers = dim_customer.select(
        "customer_key", "client_id", "income_segment", "credit_tier", "age_group", "gender", "country",
        "yearly_income_mad", "credit_score",
    )
    preferred = step(top_category(card, dim_category).drop("category_spend"))
    combined = customers.join(spending, who, "left").join(preferred, who, "left")
    return combined.select(*customers.columns, *[c for c in combined.columns if c not in customers.columns]).withColumns(
        {
            **_or_zero(*measures),
            "preferred_category": F.coalesce("preferred_category", F.lit("UNKNOWN")),
            "activity_level": rules.activity_level(F.col("total_transactions"), F.col("active_days")),
        }
    ).withColumns(
        {
            "spend_to_income_ratio": rules.round_to(_pct("total_spend_mad", "yearly_income_mad"), 2),
            "online_ratio_pct": rules.round_to(_pct("online_txns", "total_transactions"), 2),
            "_loaded_at": ctx.now(),
        }
    )


def fraud_risk_scoring(
    dim_customer: DataFrame, dim_card: DataFrame, card: DataFrame, ctx: RunContext, step: Step = _as_it_is
) -> DataFrame:
    """Customer: fraud rate, card risk and a score from 0 to 100."""
    who = _customer(card)
    txns = step(purchases_by_day(card).groupBy(who).agg(
        F.sum("n").alias("total_transactions"),
        F.sum("fraud").alias("fraud_transactions"),
        F.sum("spend").alias("total_amount_mad"),
        F.try_divide(F.sum("spend"), F.sum("amounts")).alias("avg_amount_mad"),
        F.max("most").alias("max_amount_mad"),
        F.sum("online").alias("online_transactions"),
        F.count("transaction_date").alias("active_days"),
    ).withColumn("fraud_rate_pct", rules.round_to(_pct("fraud_transactions", "total_transactions"), 4)))
    cards = dim_card.groupBy("customer_key").agg(
        F.count("*").alias("total_cards"),
        rules.count_if(F.col("card_on_dark_web")).alias("dark_web_cards"),
        rules.count_if(F.col("is_expired")).alias("expired_cards"),
        F.max("credit_limit_mad").alias("max_credit_limit_mad"),
    )
    measures = [c for c in txns.columns if c != who] + [c for c in cards.columns if c != "customer_key"]
    customers = dim_customer.select(
        "customer_key", "client_id", "income_segment", "credit_tier", "debt_risk_level", "age_group", "gender", "country",
    )
    combined = (
        customers.join(txns, who, "left").join(cards, "customer_key", "left")
        .select(*customers.columns, *measures).withColumns(_or_zero(*measures))
    )
    rate, dark = F.col("fraud_rate_pct"), F.col("dark_web_cards")
    return combined.withColumns(
        {
            "fraud_risk_score": rules.fraud_risk_score(
                rate, dark, F.col("debt_risk_level"), F.col("credit_tier"), F.col("max_amount_mad"),
                ctx.fraud_amount_threshold,
            ),
            "risk_level": rules.classify_risk_level(rate, F.col("debt_risk_level"), dark),
            "_loaded_at": ctx.now(),
        }
    )


def governorate_summary(
    dim_geography: DataFrame, dim_atm: DataFrame, atm: DataFrame, wallet: DataFrame, ooc: DataFrame, ctx: RunContext
) -> DataFrame:
    """Region: terminals, volumes and rates.

    Facts are summed per terminal before the terminal's region is looked up, so
    the join and the regrouping see one row per terminal.
    """
    regions = dim_atm.select("atm_key", "region").filter(F.col("region").isNotNull())

    def per_region(fact: DataFrame, **sums: Column) -> DataFrame:
        per_atm = fact.filter(F.col("atm_key").isNotNull()).groupBy("atm_key").agg(
            *[c.alias(name) for name, c in sums.items()]
        )
        return per_atm.join(regions, "atm_key").groupBy("region").agg(*[F.sum(c).alias(c) for c in sums])

    parts = [
        dim_atm.groupBy("region").agg(F.count("*").alias("total_atms")),
        per_region(
            atm,
            atm_transactions=F.count("*"),
            atm_amount_mad=F.sum("amount_mad"),
            successful_atm_txns=rules.count_if(F.col("is_successful")),
            atm_reversals=rules.count_if(F.col("is_reversal")),
        ),
        per_region(
            wallet,
            wallet_transactions=F.count("*"),
            wallet_amount_mad=F.sum("amount_mad"),
            successful_wallet_txns=rules.count_if(F.col("is_successful")),
        ),
        per_region(ooc, ooc_events=F.count("*"), ooc_attempted_mad=F.sum("attempted_amount_mad")),
    ]
    combined = dim_geography.select("region", "country", "macro_region", "population_tier")
    for part in parts:
        combined = combined.join(part, "region", "left")
    measures = [c for part in parts for c in part.columns if c != "region"]
    combined = combined.withColumns(_or_zero(*measures))
    atm_n, wallet_n, ooc_n = F.col("atm_transactions"), F.col("wallet_transactions"), F.col("ooc_events")
    return combined.withColumns(
        {
            "total_transactions": atm_n + wallet_n,
            "total_amount_mad": F.col("atm_amount_mad") + F.col("wallet_amount_mad"),
            "atm_success_rate_pct": rules.round_to(_pct("successful_atm_txns", "atm_transactions"), 2),
            "ooc_rate_pct": rules.round_to(_pct("ooc_events", atm_n + ooc_n), 2),
            "wallet_share_pct": rules.round_to(_pct("wallet_transactions", atm_n + wallet_n), 2),
            "_loaded_at": ctx.now(),
        }
    )
