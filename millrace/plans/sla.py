"""Ticket SLA: activity rollup, per-ticket metrics, dashboard and the reports read from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import money_or_zero, percent, ratio
from millrace.functions.timing import as_timestamp, breached, elapsed_minutes
from millrace.operators.joins import BROADCAST_ROWS, lookup_join, star_join

# ---- fixed values -----------------------------------------------------------------------------
RESPONSE_LIMIT_MIN = 1
RESOLUTION_LIMIT_MIN = 15
RESPONSE_STATUS, RESOLVED_STATUS, REOPENED_STATUS = "inprogress", "resolved", "reopened"
RESPONSE_NOTE = "agent responded"
CRITICAL_PCT = 20
# ---------------------------------------------------------------------------------------------


def _low(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def is_response(status: str = "new_status", notes: str = "notes") -> Column:
    return (_low(status) == RESPONSE_STATUS) | _low(notes).contains(RESPONSE_NOTE)


def ticket_activity(events: DataFrame, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Everything later steps need from the events, one row per ticket, in one aggregation.

    All measures combine on the map side, so a ticket with very many events sends one row per
    input partition. ``extra`` adds aggregates of the caller's.
    """
    ts = as_timestamp(F.col("event_ts"))
    return events.groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("total_event_count"),
        F.count_if((_low("new_status") == REOPENED_STATUS)
                   | (_low("old_status") == REOPENED_STATUS)).alias("reopen_count"),
        F.min(F.when(is_response(), ts)).alias("first_response_ts"),
        F.min(F.when(_low("new_status") == RESOLVED_STATUS, ts)).alias("resolved_ts"),
        F.min(F.when(_low("new_status") == REOPENED_STATUS, ts)).alias("reopened_ts"),
        F.min(F.when(_low("new_status") == "closed", ts)).alias("closed_ts"),
        F.max(ts).alias("last_event_ts"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def ticket_timing(tickets: DataFrame, activity: DataFrame, response_limit: Column | float = RESPONSE_LIMIT_MIN,
                  resolution_limit: Column | float = RESOLUTION_LIMIT_MIN) -> DataFrame:
    """Response and resolution minutes and breach flags per ticket.

    ``tickets`` has ``ticket_id, order_id, created_at``. Limits are numbers, or columns of
    ``tickets`` for limits by priority. ``is_reopened``: any event after the first resolution.
    """
    created = as_timestamp(F.col("created_at"))
    joined = tickets.join(activity, "ticket_id", "left").withColumn("ticket_created_ts", created)
    timed = joined.withColumns({
        "first_response_time": elapsed_minutes(F.col("ticket_created_ts"), F.col("first_response_ts")),
        "resolution_time": elapsed_minutes(F.col("ticket_created_ts"), F.col("resolved_ts")),
    })
    return timed.withColumns({
        "first_response_breached": breached(F.col("first_response_time"), response_limit,
                                            F.col("first_response_ts")),
        "resolution_breached": breached(F.col("resolution_time"), resolution_limit,
                                        F.col("resolved_ts")),
        "is_reopened": F.coalesce(F.col("last_event_ts") > F.col("resolved_ts"), F.lit(False)),
    })


TIMING = ("ticket_id", "order_id", "ticket_created_ts", "first_response_ts", "resolved_ts",
          "first_response_time", "resolution_time", "first_response_breached",
          "resolution_breached", "is_reopened")
FACT_COLUMNS = ("ticket_sk", "ticket_created_date_sk", "ticket_created_time_sk", "order_date_sk",
                "order_time_sk", "ticket_status", "order_status", "is_escalated", "reopen_count",
                "refund_amount", "compensation_amount", "credit_amount", "total_revenue_impact",
                "batch_id", "total_event_count")


DASHBOARD_DIMS = ("driver", "restaurant")  # the dashboard names no others
DIMENSION_KEYS = ("customer_sk", "driver_sk", "restaurant_sk", "channel_sk", "priority_sk", "reason_sk")


def with_fact(timing: DataFrame, fact: DataFrame) -> DataFrame:
    """Timing of every ticket with the attributes and keys of its fact row, if it has one."""
    return timing.select(*TIMING).join(
        fact.select("ticket_id", *FACT_COLUMNS, *DIMENSION_KEYS), "ticket_id", "left")


def sla_metrics(base: DataFrame, dims: Mapping[str, DataFrame],
                max_rows: int = BROADCAST_ROWS, keys: DataFrame | None = None) -> DataFrame:
    """Per-ticket SLA with fact attributes and dimension names.

    ``base`` comes from :func:`with_fact`; ``dims`` holds ``customer, driver, restaurant, channel,
    priority, reason``, or those whose names are wanted. ``keys`` is for :func:`star_join`, which meets it by ``ticket_id``.
    """
    names = {
        "customer": {"city_name": "customer_city"},
        "driver": {"city_name": "driver_city"},
        "restaurant": {"restaurant_name": "restaurant_name", "city_name": "restaurant_city"},
        "channel": {"channel_name": "channel_name"},
        "priority": {"priority_name": "priority_name"},
        "reason": {"reason_name": "reason_name"},
    }
    wanted = {d: n for d, n in names.items() if d in dims}
    named = star_join(base, [(dims[d], f"{d}_sk", n) for d, n in wanted.items()], max_rows, keys, "ticket_id")
    defaults = {"customer_city": "UNKNOWN", "driver_city": "UNKNOWN", "restaurant_name": "UNKNOWN",
                "restaurant_city": "UNKNOWN", "channel_name": "UNKNOWN",
                "priority_name": "STANDARD", "reason_name": "OTHER"}
    found = {c for n in wanted.values() for c in n.values()}
    return named.select(*[c for c in base.columns if c not in DIMENSION_KEYS],
                        *[F.coalesce(n, F.lit(v)).alias(n) for n, v in defaults.items() if n in found])


def sla_dashboard(metrics: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """KPIs by restaurant city, restaurant and driver city, for tickets with known cities."""
    known = metrics.filter((F.col("restaurant_city") != "UNKNOWN") & (F.col("driver_city") != "UNKNOWN"))
    n = F.count(F.lit(1))
    refund = money_or_zero(F.col("refund_amount"))
    any_breach = F.col("first_response_breached") | F.col("resolution_breached")

    def mean(c: str) -> Column:
        return ratio(F.sum(c), F.count(c))

    board = known.groupBy("restaurant_city", "restaurant_name", "driver_city").agg(
        F.count_distinct("ticket_id").alias("total_tickets"),
        percent(F.count_if(any_breach), n).alias("sla_breach_rate_pct"),
        percent(F.count_if("first_response_breached"), n).alias("first_response_breach_rate_pct"),
        percent(F.count_if("resolution_breached"), n).alias("resolution_breach_rate_pct"),
        percent(F.count_if("is_reopened"), n).alias("reopen_rate_pct"),
        mean("first_response_time").alias("avg_first_response_time"),
        mean("resolution_time").alias("avg_resolution_time"),
        F.max("resolution_time").alias("max_resolution_time"),
        F.min("resolution_time").alias("min_resolution_time"),
        F.sum(refund).alias("total_refunds"),
        F.sum(money_or_zero(F.col("total_revenue_impact"))).alias("total_revenue_impact"),
        ratio(F.sum(refund), n).alias("avg_refund_per_ticket"),
    )
    stamp = refreshed_at if refreshed_at is not None else F.current_timestamp()
    return board.withColumn("view_refreshed_at", stamp).orderBy(
        F.col("sla_breach_rate_pct").desc(), F.col("total_tickets").desc())


def dashboard_summary(board: DataFrame) -> DataFrame:
    return board.select(
        "restaurant_city", "restaurant_name", "driver_city", "total_tickets", "sla_breach_rate_pct",
        "first_response_breach_rate_pct", "resolution_breach_rate_pct", "reopen_rate_pct",
        "avg_resolution_time", "total_refunds", "total_revenue_impact",
    ).orderBy(F.col("sla_breach_rate_pct").desc(), F.col("total_tickets").desc())


def breach_alerts(board: DataFrame, threshold_pct: float = 10.0) -> DataFrame:
    rate = F.col("sla_breach_rate_pct")
    level = (F.when(rate >= CRITICAL_PCT, "CRITICAL").when(rate >= threshold_pct, "WARNING")
             .otherwise("OK"))
    return board.filter(rate >= threshold_pct).select(
        "restaurant_city", "restaurant_name", "driver_city", "total_tickets", "sla_breach_rate_pct",
        "resolution_breach_rate_pct", "reopen_rate_pct", level.alias("alert_level"),
    ).orderBy(rate.desc())


def high_reopen(board: DataFrame, threshold_pct: float = 5.0) -> DataFrame:
    rate = F.col("reopen_rate_pct")
    return board.filter(rate >= threshold_pct).select(
        "restaurant_city", "restaurant_name", "driver_city", "total_tickets", "reopen_rate_pct",
        "sla_breach_rate_pct", "avg_resolution_time",
    ).orderBy(rate.desc())


def limits_by_priority(tickets: DataFrame, priorities: DataFrame) -> DataFrame:
    """Tickets with their priority's own limits, for :func:`ticket_timing`."""
    limits = priorities.select("priority_id", "sla_first_response_min", "sla_resolution_min")
    return lookup_join(tickets, limits, "priority_id")
