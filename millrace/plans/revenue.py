"""Revenue impact of tickets by business dimension, immune to fan-out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import money_or_zero, percent, ratio
from millrace.operators.joins import BROADCAST_ROWS, star_join

AMOUNTS = ("total_revenue_impact", "refund_amount", "compensation_amount", "credit_amount")
KEYS = ("restaurant_sk", "channel_sk", "priority_sk", "reason_sk")
GROUP = ("restaurant_city", "restaurant_name", "channel_name", "priority_name", "reason_name")


def ticket_grain(fact: DataFrame) -> DataFrame:
    """One row per ticket: the highest amount and key of its fact rows."""
    return (fact.filter(F.col("ticket_id").isNotNull()).groupBy("ticket_id").agg(
        *[F.max(money_or_zero(F.col(a))).alias(a) for a in AMOUNTS],
        *[F.max(k).alias(k) for k in KEYS]))


def revenue_impact(fact: DataFrame, dims: Mapping[str, DataFrame],
                   max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Impact by restaurant, channel, priority and reason; dimensions join at ticket grain.

    Only dimensions the result names are joined.
    """
    named = star_join(ticket_grain(fact), [
        (dims["restaurant"], "restaurant_sk",
         {"city_name": "restaurant_city", "restaurant_name": "restaurant_name"}),
        (dims["channel"], "channel_sk", {"channel_name": "channel_name"}),
        (dims["priority"], "priority_sk", {"priority_name": "priority_name"}),
        (dims["reason"], "reason_sk", {"reason_name": "reason_name"}),
    ], max_rows).withColumns({g: F.coalesce(g, F.lit("UNKNOWN")) for g in GROUP})
    n = F.count(F.lit(1))
    return named.groupBy(*GROUP).agg(
        n.alias("impacted_tickets"),
        F.sum("total_revenue_impact").alias("total_revenue_impact"),
        F.sum("refund_amount").alias("total_refund_amount"),
        F.sum("compensation_amount").alias("total_compensation_amount"),
        F.sum("credit_amount").alias("total_credit_amount"),
        ratio(F.sum("total_revenue_impact"), n).alias("avg_revenue_impact_per_ticket"),
        percent(F.count_if(F.col("total_revenue_impact") > 0), n).alias("impacted_ticket_rate_pct"),
    ).orderBy(F.col("total_revenue_impact").desc(), F.col("impacted_tickets").desc())
