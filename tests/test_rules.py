"""Column functions on edge values."""

import datetime as dt

from pyspark.sql import functions as F

from sarraf.functions import rules, text
from sarraf.functions.keys import surrogate_key


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_money_text(spark):
    for raw, value in (("$1,234.50", 1234.5), ("77 MAD", 77.0), ("-12", -12.0), ("", None), ("n/a", None), (None, None)):
        assert one(spark, text.clean_money(F.lit(raw))) == value


def test_month_year(spark):
    assert one(spark, text.month_year_date(F.lit("02/2020"))) == dt.date(2020, 2, 1)
    assert one(spark, text.month_year_date(F.lit("13/2020"))) is None


def test_clock_hour(spark):
    assert one(spark, text.clock_hour(F.lit("07:15:00"))) == 7
    assert one(spark, text.clock_hour(F.lit("xx:10"))) is None


def test_digits(spark):
    assert one(spark, text.digits(F.lit("****000899"))) == 899
    assert one(spark, text.digits(F.lit("****"))) is None


def test_error_code(spark):
    for raw, value in (("51", 51), (" 14 ", 14), ("NaN", None), ("Bad PIN", None), (None, None)):
        assert one(spark, text.error_code(F.lit(raw).cast("string"))) == value


def test_yes_labels(spark):
    for raw, value in ((" yes ", True), ("OUI", True), ("1", True), ("No", False), ("False", False)):
        assert one(spark, text.is_yes(F.lit(raw))) is value


def test_masking(spark):
    assert one(spark, text.mask_number(F.lit("4444111122223333"))) == "************3333"
    assert one(spark, text.mask_number(F.lit("123"))) == "123"


def test_json_safe(spark):
    for raw, value in ((float("nan"), None), (float("inf"), None), (float("-inf"), None), (1.5, 1.5)):
        assert one(spark, text.json_safe(F.lit(raw))) == value


def test_missing_values_take_the_last_band(spark):
    nothing = F.lit(None).cast("double")
    assert one(spark, rules.age_group(nothing)) == "60+"
    assert one(spark, rules.income_segment(nothing)) == "PREMIUM"
    assert one(spark, rules.credit_tier(nothing)) == "POOR"
    assert one(spark, rules.time_of_day(nothing)) == "NIGHT"
    assert one(spark, rules.debt_to_income(F.lit(5.0), nothing)) is None
    assert one(spark, rules.debt_to_income(F.lit(5.0), F.lit(0.0))) is None


def test_band_limits(spark):
    assert [one(spark, rules.amount_bucket(F.lit(v))) for v in (99.99, 100.0, 499.0, 2000.0, 10000.0)] == [
        "MICRO", "SMALL", "SMALL", "LARGE", "VERY_LARGE"
    ]
    assert [one(spark, rules.performance_grade(F.lit(n), F.lit(p))) for n, p in ((6, 100.0), (5, 95.0), (0, 69.9))] == [
        "D", "A", "D"
    ]
    assert one(spark, rules.performance_grade(F.lit(0), F.lit(None).cast("double"))) == "D"
    assert [one(spark, rules.classify_risk_score(F.lit(v))) for v in (75, 50, 25, 24)] == [
        "CRITICAL", "HIGH", "MEDIUM", "LOW"
    ]


def test_night_hours(spark):
    assert [one(spark, rules.in_night(F.lit(h))) for h in (22, 23, 0, 5, 6)] == [False, True, True, True, False]
    assert not any(one(spark, rules.in_night(F.lit(h), literal=True)) for h in range(24))


def test_rounding_of_binary_halves(spark):
    assert one(spark, rules.round_to(F.lit(153730.0 * 100.0 / 200000.0), 2)) == 76.86
    assert one(spark, rules.round_to(F.lit(-0.125), 2)) == -0.13


def test_currency(spark):
    assert one(spark, rules.convert_to_mad(F.lit(10), "EUR")) == 109.0
    assert one(spark, rules.convert_to_mad(F.lit(10), "XXX")) == 10.0
    assert one(spark, rules.convert_to_mad(F.lit(10), F.lit("SAR"))) == 26.7


def test_score_is_capped(spark):
    score = rules.fraud_risk_score(F.lit(10.0), F.lit(1), F.lit("HIGH_RISK"), F.lit("POOR"), F.lit(1.0), 2000.0)
    assert one(spark, score) == 100.0
    low = rules.fraud_risk_score(F.lit(0.0), F.lit(0), F.lit("LOW_RISK"), F.lit("GOOD"), F.lit(2001.0), 2000.0)
    assert one(spark, low) == 5.0


def test_surrogate_key(spark):
    assert one(spark, surrogate_key(F.lit("1"))) == "c4ca4238a0b923820dcc509a6f75849b"
    null_key = one(spark, surrogate_key(F.lit(None).cast("string")))
    assert null_key == one(spark, F.md5(F.lit("_dbt_utils_surrogate_key_null_")))
    assert one(spark, surrogate_key(F.lit("a"), F.lit(1))) == one(spark, F.md5(F.lit("a-1")))
