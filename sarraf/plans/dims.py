"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.functions import fixed_values as fv, rules
from sarraf.functions.keys import surrogate_key
from sarraf.operators.dedup import distinct_values, first_per_key


def dim_atm(stg: DataFrame) -> DataFrame:
    return stg.withColumns(
        {
            "atm_key": surrogate_key("atm_id"),
            "atm_maturity": rules.atm_maturity(F.col("atm_age_years")),
            "capacity_tier": rules.capacity_tier(F.col("cash_limit_mad")),
        }
    )


def dim_customer(stg: DataFrame) -> DataFrame:
    return stg.withColumns(
        {
            "customer_key": surrogate_key("client_id"),
            "debt_risk_level": rules.debt_risk_level(F.col("debt_to_income_ratio")),
            "credit_usage_tier": rules.credit_usage_tier(F.col("num_credit_cards")),
        }
    )


def dim_card(stg: DataFrame) -> DataFrame:
    return stg.withColumns(
        {
            "card_key": surrogate_key("card_id"),
            "customer_key": surrogate_key("client_id"),
            "card_risk_level": rules.card_risk_level(
                F.col("card_on_dark_web"), F.col("is_expired"), F.col("card_age_years")
            ),
        }
    )


def dim_date(spark: SparkSession) -> DataFrame:
    """One row per calendar day; the end day itself is not part of it."""
    first, end = F.lit(fv.CALENDAR_START).cast("date"), F.lit(fv.CALENDAR_END_EXCLUSIVE).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, F.date_sub(end, 1))).alias("full_date"))
    d = F.col("full_date")
    weekday = F.dayofweek(d) - 1                       # 0 is Sunday
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_number"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.date_format(d, "MM-dd").isin(fv.HOLIDAYS).alias("is_moroccan_holiday"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def dim_geography(stg_atm: DataFrame, stg_transactions: DataFrame, literal: bool = False) -> DataFrame:
    """Regions of terminals and merchants.

    The location flags say where a region comes from; ``literal`` sets both to
    TRUE for every region.  One pre-aggregated grouping serves as the union.
    """
    atm = stg_atm.select("region", F.lit(True).alias("atm"), F.lit(False).alias("merchant"))
    merchant = stg_transactions.select(
        F.col("merchant_region").alias("region"), F.lit(False).alias("atm"), F.lit(True).alias("merchant")
    )
    regions = (
        atm.unionByName(merchant).filter(F.col("region").isNotNull())
        .groupBy("region").agg(F.bool_or("atm").alias("atm"), F.bool_or("merchant").alias("merchant"))
        .withColumn("country", F.lit(fv.COUNTRY))
    )
    always = F.lit(True)
    return regions.select(
        surrogate_key("region", "country").alias("geography_key"),
        "region", "country",
        rules.macro_region(F.col("region")).alias("macro_region"),
        rules.population_tier(F.col("region")).alias("population_tier"),
        (always if literal else F.col("atm")).alias("is_atm_location"),
        (always if literal else F.col("merchant")).alias("is_merchant_location"),
    )


def dim_merchant(stg_transactions: DataFrame) -> DataFrame:
    """One canonical row per merchant: the first by city, region, zip and category.

    Distinct combinations are taken first, so ranking sees few rows per
    merchant even if one merchant owns a large share of the purchases.
    """
    details = ["merchant_city", "merchant_region", "zip", "mcc"]
    seen = distinct_values(stg_transactions.filter(F.col("merchant_id").isNotNull()), "merchant_id", *details)
    chosen = first_per_key(seen, ["merchant_id"], [F.col(c).asc_nulls_last() for c in details])
    return chosen.select(
        surrogate_key("merchant_id").alias("merchant_key"),
        "merchant_id", "merchant_city", "merchant_region", "zip",
        F.col("mcc").alias("mcc_code"),
        rules.is_listed(F.col("mcc"), [fv.ATM_MCC]).alias("is_atm_merchant"),
        rules.merchant_category_group(F.col("mcc")).alias("merchant_category_group"),
        F.lit(fv.COUNTRY).alias("country"),
    )


def dim_merchant_category(stg_transactions: DataFrame) -> DataFrame:
    codes = distinct_values(stg_transactions.filter(F.col("mcc").isNotNull()), "mcc").withColumnRenamed("mcc", "mcc_code")
    code = F.col("mcc_code")
    return codes.select(
        surrogate_key("mcc_code").alias("merchant_category_key"),
        "mcc_code",
        rules.mcc_description(code).alias("mcc_description"),
        rules.mcc_category_group(code).alias("category_group"),
        rules.is_listed(code, fv.HIGH_RISK_MCC).alias("is_high_risk_mcc"),
    )


def primary_cards(dim_card: DataFrame) -> DataFrame:
    """One card per customer: the lowest card id as text."""
    first = dim_card.groupBy("client_id").agg(F.min("card_id").alias("card_id"))
    return first.withColumn("card_key", surrogate_key("card_id"))


def pan_customer_map(silver_map: DataFrame, dim_customer: DataFrame, dim_card: DataFrame) -> DataFrame:
    """Bridge from PAN to client, customer key and primary card."""
    customers = dim_customer.select("client_id", "customer_key")
    return (
        silver_map.filter(F.col("pan_masked").isNotNull())
        .join(customers, "client_id", "left")
        .join(primary_cards(dim_card), "client_id", "left")
        .select(
            surrogate_key("pan_masked").alias("pan_key"),
            F.col("pan_masked").cast("string").alias("pan_masked"),
            F.col("pan_num").cast("bigint").alias("pan_number"),
            F.col("client_id").cast("string").alias("client_id"),
            "customer_key", "card_id", "card_key", "_created_at",
        )
    )
