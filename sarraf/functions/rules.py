"""Business rules: bands, lookups, ratios, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from sarraf.functions import fixed_values as fv


# --- building blocks -------------------------------------------------------

def below(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper limit that ``c`` is under; NULL takes ``otherwise``."""
    return _first_match([(c < limit, label) for limit, label in bands], otherwise)


def at_least(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first lower limit that ``c`` reaches."""
    return _first_match([(c >= limit, label) for limit, label in bands], otherwise)


def above(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit that ``c`` exceeds."""
    return _first_match([(c > limit, label) for limit, label in bands], otherwise)


def group_of(c: Column, groups: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """Name of the group that lists ``c``."""
    return _first_match([(c.isin(list(members)), name) for name, members in groups.items()], otherwise)


def _first_match(cases: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def ratio_pct(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, unrounded; NULL for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))


def round_to(c: Column, digits: int) -> Column:
    """Rounded the way the marts are defined: the scaled double, halves away from zero.

    ``F.round`` rounds the decimal text of a double instead, so that 76.865
    (a little less in binary) becomes 76.87 there and 76.86 here.
    """
    scale = float(10**digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def mean_of_rounded(column: str, digits: int) -> Column:
    """Mean of a column that was rounded to ``digits``, rounded to ``digits`` again.

    The values are summed as whole numbers of the last digit.  A sum of doubles
    depends on the order of the rows, and a mean half way between two results
    would then round up in one run and down in the next.
    """
    scale = float(10**digits)
    units = F.sum(F.round(F.col(column) * F.lit(scale)).cast("bigint"))
    return F.round(F.try_divide(units.cast("double"), F.count(column))) / F.lit(scale)


def count_if(c: Column) -> Column:
    """Number of rows where ``c`` is true, 0 for none."""
    return F.count_if(c)


def whole_years(later: Column, earlier: Column) -> Column:
    return F.floor(F.datediff(later, earlier) / 365).cast("int")


# --- customers and cards ---------------------------------------------------

def age_group(age: Column) -> Column:
    return below(age, [(30, "18-29"), (45, "30-44"), (60, "45-59")], "60+")


def income_segment(income: Column) -> Column:
    return below(income, [(60000, "LOW"), (150000, "MEDIUM"), (300000, "HIGH")], "PREMIUM")


def credit_tier(score: Column) -> Column:
    return at_least(score, [(750, "EXCELLENT"), (670, "GOOD"), (580, "FAIR")], "POOR")


def debt_to_income(debt: Column, income: Column) -> Column:
    return F.when(income > 0, F.round(F.try_divide(debt, income), 2))


def debt_risk_level(ratio: Column) -> Column:
    return above(ratio, [(0.5, "HIGH_RISK"), (0.3, "MEDIUM_RISK")], "LOW_RISK")


def credit_usage_tier(cards: Column) -> Column:
    return at_least(cards, [(5, "HEAVY_USER"), (3, "MODERATE_USER")], "LIGHT_USER")


def card_category(card_type: Column) -> Column:
    return group_of(card_type, {"CREDIT": fv.CREDIT_LABELS, "DEBIT": fv.DEBIT_LABELS}, "OTHER")


def dark_web_risk(on_dark_web: Column) -> Column:
    return F.when(on_dark_web, F.lit("HIGH")).otherwise(F.lit("LOW"))


def card_risk_level(on_dark_web: Column, expired: Column, age_years: Column) -> Column:
    return _first_match([(on_dark_web, "CRITICAL"), (expired, "HIGH"), (age_years > 5, "MEDIUM")], "LOW")


# --- terminals, places, merchants -------------------------------------------

def atm_maturity(age_years: Column) -> Column:
    return _first_match([(age_years <= 2, "NEW"), (age_years <= 5, "ESTABLISHED")], "MATURE")


def capacity_tier(cash_limit: Column) -> Column:
    return at_least(
        cash_limit, [(1_000_000, "HIGH_CAPACITY"), (800_000, "MEDIUM_CAPACITY")], "LOW_CAPACITY"
    )


def macro_region(region: Column) -> Column:
    return group_of(region, fv.MACRO_REGIONS, "OTHER")


def population_tier(region: Column) -> Column:
    return group_of(region, fv.POPULATION_TIERS, "TIER_3")


def merchant_category_group(mcc: Column) -> Column:
    return group_of(mcc, fv.MERCHANT_GROUPS, "OTHER")


def mcc_category_group(mcc: Column) -> Column:
    return group_of(mcc, fv.CATEGORY_GROUPS, "Other")


def mcc_description(mcc: Column) -> Column:
    known = F
    for code, label in fv.MCC_DESCRIPTIONS.items():
        known = known.when(mcc == code, F.lit(label))
    return known.otherwise(F.concat(F.lit("MCC-"), mcc))


def is_listed(c: Column, values: Sequence) -> Column:
    """Membership that is false, not NULL, for NULL."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


# --- transactions ------------------------------------------------------------

def amount_bucket(amount: Column) -> Column:
    return below(amount, [(100, "MICRO"), (500, "SMALL"), (2000, "MEDIUM"), (10000, "LARGE")], "VERY_LARGE")


def purchase_channel(online: Column, chip: Column) -> Column:
    return _first_match([(online, fv.CHANNEL_ONLINE), (chip, fv.CHANNEL_POS)], fv.CHANNEL_SWIPE)


def in_morning(hour: Column) -> Column:
    return hour.between(6, 11)


def in_afternoon(hour: Column) -> Column:
    return hour.between(12, 17)


def in_evening(hour: Column) -> Column:
    return hour.between(18, 22)


def in_night(hour: Column, literal: bool = False) -> Column:
    """Hours 23 to 5.  ``literal`` keeps the empty range 23..5, which no hour meets."""
    return hour.between(23, 5) if literal else (hour >= 23) | (hour <= 5)


def time_of_day(hour: Column) -> Column:
    return _first_match(
        [(in_morning(hour), "MORNING"), (in_afternoon(hour), "AFTERNOON"), (in_evening(hour), "EVENING")],
        "NIGHT",
    )


def convert_to_mad(amount: Column, currency: str | Column) -> Column:
    """Amount in MAD, two decimals.  ``currency`` is a code or a column of codes."""
    if isinstance(currency, str):
        rate = F.lit(fv.MAD_RATES.get(currency, 1.0))
    else:
        rate = F
        for code, value in fv.MAD_RATES.items():
            rate = rate.when(currency == code, F.lit(value))
        rate = rate.otherwise(F.lit(1.0))
    return round_to(amount.cast("double") * rate, 2)


# --- marts -------------------------------------------------------------------

def performance_grade(ooc_events: Column, success_pct: Column) -> Column:
    return _first_match(
        [(ooc_events > 5, "D"), (success_pct >= 95, "A"), (success_pct >= 85, "B"), (success_pct >= 70, "C")],
        "D",
    )


def replenishment_urgency(ooc_events: Column) -> Column:
    return _first_match(
        [(ooc_events > 3, "CRITICAL"), (ooc_events > 1, "HIGH"), (ooc_events == 1, "MEDIUM")], "LOW"
    )


def replenishment_status(utilization_pct: Column) -> Column:
    return above(utilization_pct, [(80, "URGENT"), (60, "SOON")], "OK")


def urgency_rank(urgency: Column) -> Column:
    return F.when(urgency == "CRITICAL", 1).when(urgency == "HIGH", 2).when(urgency == "MEDIUM", 3).otherwise(4)


def activity_level(transactions: Column, active_days: Column) -> Column:
    return _first_match(
        [
            (F.coalesce(transactions, F.lit(0)) == 0, "INACTIVE"),
            (active_days >= 20, "VERY_ACTIVE"),
            (active_days >= 10, "ACTIVE"),
            (active_days >= 3, "OCCASIONAL"),
        ],
        "RARE",
    )


def fraud_risk_score(
    rate_pct: Column, dark_web_cards: Column, debt_risk: Column, tier: Column, max_amount: Column, threshold: float
) -> Column:
    """0 to 100: fraud rate weighted by 40, plus fixed points per risk mark."""
    points = rate_pct * F.lit(40.0)
    for hit, weight in (
        (dark_web_cards > 0, 30.0),
        (debt_risk == "HIGH_RISK", 15.0),
        (tier == "POOR", 10.0),
        (max_amount > threshold, 5.0),
    ):
        points = points + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(F.lit(100.0), round_to(points, 2))


def classify_risk_level(rate_pct: Column, debt_risk: Column, dark_web_cards: Column) -> Column:
    return _first_match(
        [
            (dark_web_cards > 0, "CRITICAL"),
            (rate_pct > 10, "HIGH"),
            ((rate_pct > 5) | (debt_risk == "HIGH_RISK"), "MEDIUM"),
        ],
        "LOW",
    )


def classify_risk_score(score: Column) -> Column:
    return at_least(score, [(75, "CRITICAL"), (50, "HIGH"), (25, "MEDIUM")], "LOW")
