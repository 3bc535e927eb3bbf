"""Flattened dimensions of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.masking import pii_hash
from millrace.operators.joins import lookup_join
from millrace.operators.keys import number_by_key, stable_keys


def _with_key(rows: DataFrame, natural: str, key: str, known: DataFrame | None) -> DataFrame:
    """Number the rows, or keep the keys an earlier version of the dimension gave them."""
    if known is None:
        return number_by_key(rows, natural, key)
    return stable_keys(rows, known, natural, key)


def _places(regions: DataFrame, cities: DataFrame) -> DataFrame:
    fee = F.col("delivery_base_fee").try_cast("decimal(18,2)").alias("delivery_base_fee")
    return lookup_join(regions, cities, "city_id").select(
        "region_id", "city_name", "region_name", "country", "timezone", fee)


def _private(name: str, hashed: bool) -> Column:
    """``hashed_<name>``; ``hashed`` says the source already holds the hash."""
    c = F.col(name)
    return (c if hashed else pii_hash(c)).alias(f"hashed_{name}")


def _int(name: str) -> Column:
    return F.col(name).try_cast("int").alias(name)


def _stamp(df: DataFrame, at: Column | None) -> DataFrame:
    return df.withColumn("row_effective_ts", at if at is not None else F.current_timestamp())


def dim_customer(customers: DataFrame, regions: DataFrame, cities: DataFrame, segments: DataFrame,
                 known: DataFrame | None = None, at: Column | None = None, hashed: bool = False) -> DataFrame:
    plans = segments.select("segment_id", "segment_name",
                            F.col("discount_pct").try_cast("int").alias("segment_discount_pct"),
                            F.col("priority_support").alias("segment_priority_support"))
    flat = lookup_join(lookup_join(customers, _places(regions, cities), "region_id"), plans, "segment_id")
    rows = flat.select(
        "customer_id",
        _private("full_name", hashed),
        _private("email", hashed),
        _private("phone", hashed),
        "gender", F.col("signup_date").cast("date").alias("signup_date"),
        "segment_name", "segment_discount_pct", "segment_priority_support",
        "city_name", "region_name", "country", "timezone", "delivery_base_fee",
        F.lit(True).alias("is_active"),
    )
    return _stamp(_with_key(rows, "customer_id", "customer_sk", known), at)


def dim_driver(drivers: DataFrame, regions: DataFrame, cities: DataFrame,
               known: DataFrame | None = None, at: Column | None = None, hashed: bool = False) -> DataFrame:
    rows = lookup_join(drivers, _places(regions, cities), "region_id").select(
        "driver_id",
        _private("driver_name", hashed),
        _private("driver_phone", hashed),
        _private("national_id", hashed),
        "shift", "vehicle_type", F.col("hire_date").cast("date").alias("hire_date"),
        F.col("rating_avg").try_cast("decimal(3,2)").alias("rating_avg"),
        F.col("on_time_rate").try_cast("decimal(5,2)").alias("on_time_rate"),
        F.col("cancel_rate").try_cast("decimal(5,2)").alias("cancel_rate"),
        _int("completed_deliveries"), "is_active",
        "city_name", "region_name", "country", "timezone", "delivery_base_fee",
    )
    return _stamp(_with_key(rows, "driver_id", "driver_sk", known), at)


def dim_restaurant(restaurants: DataFrame, categories: DataFrame, regions: DataFrame,
                   cities: DataFrame, known: DataFrame | None = None,
                   at: Column | None = None) -> DataFrame:
    flat = lookup_join(restaurants, _places(regions, cities), "region_id")
    rows = lookup_join(flat, categories.select("category_id", "category_name"), "category_id").select(
        "restaurant_id", "restaurant_name", "category_name", "price_tier",
        F.col("rating_avg").try_cast("decimal(3,2)").alias("rating_avg"),
        _int("prep_time_avg_min"), "is_active",
        "city_name", "region_name", "country", "timezone", "delivery_base_fee",
    )
    return _stamp(_with_key(rows, "restaurant_id", "restaurant_sk", known), at)


def dim_agent(agents: DataFrame, teams: DataFrame, known: DataFrame | None = None,
              at: Column | None = None, hashed: bool = False) -> DataFrame:
    rows = lookup_join(agents, teams.select("team_id", "team_name"), "team_id").select(
        "agent_id",
        _private("agent_name", hashed),
        _private("agent_email", hashed),
        _private("agent_phone", hashed),
        "skill_level", F.col("hire_date").cast("date").alias("hire_date"),
        _int("avg_handle_time_min"),
        F.col("resolution_rate").try_cast("decimal(5,2)").alias("resolution_rate"),
        F.col("csat_score").try_cast("decimal(3,2)").alias("csat_score"),
        "is_active", "team_name",
    )
    return _stamp(_with_key(rows, "agent_id", "agent_sk", known), at)


def dim_reason(reasons: DataFrame, categories: DataFrame, known: DataFrame | None = None) -> DataFrame:
    named = categories.select("reason_category_id", F.col("category_name").alias("reason_category_name"))
    rows = lookup_join(reasons, named, "reason_category_id").select(
        "reason_id", "reason_name", "reason_category_name", _int("severity_level"),
        F.col("typical_refund_pct").try_cast("decimal(5,2)").alias("typical_refund_pct"))
    return _with_key(rows, "reason_id", "reason_sk", known)


def dim_priority(priorities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    rows = priorities.select("priority_id", "priority_code", "priority_name",
                             _int("sla_first_response_min"), _int("sla_resolution_min"))
    return _with_key(rows, "priority_id", "priority_sk", known)


def dim_channel(channels: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The sources carry no channel type; it stays null unless the input has one."""
    kind = F.col("channel_type") if "channel_type" in channels.columns else F.lit(None).cast("string")
    rows = channels.select("channel_id", "channel_name", kind.alias("channel_type"))
    return _with_key(rows, "channel_id", "channel_sk", known)


def dim_date(span: DataFrame, holidays: DataFrame | None = None,
             weekend: Sequence[str] = ("Saturday", "Sunday"),
             fiscal_period: Column | None = None) -> DataFrame:
    """Calendar between ``first_day`` and ``last_day`` of the one-row ``span``.

    Holidays come from a list (``full_date``), the fiscal period from an expression over
    ``full_date``; without them the columns are null.
    """
    days = span.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day")))
                       .alias("full_date"))
    day = F.col("full_date")
    name = F.date_format(day, "EEEE")
    out = days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        "full_date",
        (F.weekday(day) + 1).alias("day_of_week"),
        name.alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        name.isin(*weekend).alias("is_weekend"),
        (fiscal_period if fiscal_period is not None else F.lit(None).cast("string"))
        .alias("fiscal_period"),
    )
    if holidays is None:
        return out.withColumn("is_egyptian_holiday", F.lit(None).cast("boolean"))
    listed = holidays.select("full_date").distinct().withColumn("_holiday", F.lit(True))
    return lookup_join(out, listed, "full_date").withColumn(
        "is_egyptian_holiday", F.coalesce("_holiday", F.lit(False))).drop("_holiday")


def dim_time(spark: SparkSession, bands: dict[str, tuple[int, int]] | None = None,
             peak_hours: Sequence[int] | None = None) -> DataFrame:
    """The 1,440 minutes of a day. Bands (name: first hour, last hour) and peak hours are given by
    the caller; without them the columns are null."""
    minutes = spark.range(1440).select(F.col("id").cast("int").alias("time_sk"))
    hour = F.floor(F.col("time_sk") / 60).cast("int")
    minute = (F.col("time_sk") % 60).cast("int")
    band: Column = F.lit(None).cast("string")
    for name, (first, last) in (bands or {}).items():
        band = F.when(hour.between(first, last), name).otherwise(band)
    peak = F.lit(None).cast("string")
    if peak_hours is not None:
        peak = F.when(hour.isin(*peak_hours), "PEAK").otherwise("OFF_PEAK")
    return minutes.select(
        "time_sk", F.format_string("%02d:%02d", hour, minute).alias("full_time"),
        hour.alias("hour_24"), minute.alias("minute"), band.alias("time_band"), peak.alias("peak_flag"))
