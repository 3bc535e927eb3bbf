"""The ticket-lifecycle fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.money import money, money_or_zero, refund_pct
from millrace.functions.timing import as_timestamp, date_key, elapsed_minutes, time_key
from millrace.operators.joins import BROADCAST_ROWS, not_in_target, star_join
from millrace.operators.keys import max_key, number_by_key
from millrace.plans.sla import RESOLUTION_LIMIT_MIN, RESPONSE_LIMIT_MIN, ticket_timing

DIMENSION_KEYS = {
    "customer": ("customer_id", "customer_sk"),
    "driver": ("driver_id", "driver_sk"),
    "restaurant": ("restaurant_id", "restaurant_sk"),
    "agent": ("agent_id", "agent_sk"),
    "channel": ("channel_id", "channel_sk"),
    "priority": ("priority_id", "priority_sk"),
    "reason": ("reason_id", "reason_sk"),
}
MOMENTS = {
    "order": "order_created_at",
    "ticket_created": "ticket_created_ts",
    "first_response": "first_response_ts",
    "resolved": "resolved_ts",
    "reopened": "reopened_ts",
    "closed": "closed_ts",
}
REQUIRED_TABLES = ("silver_tickets", "silver_orders", "silver_ticket_events")

_money, _int, _bool, _text = T.DecimalType(18, 2), T.IntegerType(), T.BooleanType(), T.StringType()
FACT_SCHEMA = T.StructType([
    T.StructField("ticket_sk", T.LongType()),
    T.StructField("ticket_id", _text),
    T.StructField("order_id", _text),
    *[T.StructField(sk, T.LongType()) for _, sk in DIMENSION_KEYS.values()],
    *[T.StructField(f"{m}_{part}_sk", _int) for m in MOMENTS for part in ("date", "time")],
    T.StructField("ticket_status", _text),
    T.StructField("order_status", _text),
    T.StructField("order_item_count", _int),
    *[T.StructField(f"order_{n}", _money)
      for n in ("subtotal", "discount_amount", "delivery_fee", "total_amount")],
    T.StructField("order_prep_time_min", _int),
    T.StructField("order_delivery_time_min", _int),
    T.StructField("order_total_time_min", _int),
    T.StructField("order_is_late", _bool),
    T.StructField("first_response_time_min", _int),
    T.StructField("resolution_time_min", _int),
    T.StructField("order_to_ticket_time_min", _int),
    T.StructField("sla_first_response_breached", _bool),
    T.StructField("sla_resolution_breached", _bool),
    *[T.StructField(n, _money)
      for n in ("refund_amount", "compensation_amount", "credit_amount", "total_revenue_impact")],
    T.StructField("refund_impact_pct", T.DecimalType(5, 2)),
    T.StructField("total_event_count", _int),
    T.StructField("reopen_count", _int),
    T.StructField("is_reopened", _bool),
    T.StructField("is_escalated", _bool),
    T.StructField("batch_id", _text),
])


def resolve_keys(rows: DataFrame, dims: Mapping[str, DataFrame],
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Natural keys to surrogate keys; an unknown or missing key gives null."""
    found = [(dims[d], natural, {sk: sk}) for d, (natural, sk) in DIMENSION_KEYS.items()
             if d in dims and natural in rows.columns]
    out = star_join(rows, found, max_rows) if found else rows
    return out.withColumns({sk: F.lit(None).cast("bigint")
                            for _, sk in DIMENSION_KEYS.values() if sk not in out.columns})


def moment_keys() -> dict[str, Column]:
    """Date and time keys of the six moments of a ticket."""
    keys: dict[str, Column] = {}
    for moment, ts in MOMENTS.items():
        at = as_timestamp(F.col(ts))
        keys[f"{moment}_date_sk"] = date_key(at)
        keys[f"{moment}_time_sk"] = time_key(at)
    return keys


TICKET = ("ticket_id", "order_id", "status", "created_at", "refund_amount")
BOUGHT = ("order_status", "order_amount", "discount_amount", "delivery_fee", "total_amount", "order_created_at",
          "delivered_at")


def with_orders(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Tickets that have an id, with the columns of their order."""
    return tickets.filter(F.col("ticket_id").isNotNull()).join(orders.select("order_id", *BOUGHT), "order_id", "left")


def fact_rows(tickets: DataFrame, orders: DataFrame | None, activity: DataFrame, batch_id: str,
              response_limit: Column | float = RESPONSE_LIMIT_MIN,
              resolution_limit: Column | float = RESOLUTION_LIMIT_MIN,
              keep: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ticket, before keys: order amounts, refund, activity counts, timing, flags.

    Silver holds one row per key, so both joins keep the ticket grain. Orders come first: the narrow tickets are
    shuffled for them, and rows leave the join with the activity placed by ticket; None where tickets come
    from :func:`with_orders`. ``keep`` passes further columns of the timing through.
    """
    ordered_tickets = tickets if orders is None else with_orders(tickets, orders)
    rows = ticket_timing(ordered_tickets, activity, response_limit, resolution_limit)
    zero = F.lit(0).cast("decimal(18,2)")
    naturals = [n for n, _ in DIMENSION_KEYS.values() if n in rows.columns]
    numbered = [c for c in ("ticket_sk",) if c in rows.columns]
    ordered = as_timestamp(F.col("order_created_at"))
    delivered = as_timestamp(F.col("delivered_at"))
    reopens = F.coalesce("reopen_count", F.lit(0))
    return rows.select(
        *numbered, "ticket_id", "order_id", *naturals,
        *[c.alias(n) for n, c in moment_keys().items()],
        F.col("status").alias("ticket_status"), "order_status",
        money(F.col("order_amount")).alias("order_subtotal"),
        money(F.col("discount_amount")).alias("order_discount_amount"),
        money(F.col("delivery_fee")).alias("order_delivery_fee"),
        money(F.col("total_amount")).alias("order_total_amount"),
        elapsed_minutes(ordered, delivered).cast("int").alias("order_total_time_min"),
        F.col("first_response_time").cast("int").alias("first_response_time_min"),
        F.col("resolution_time").cast("int").alias("resolution_time_min"),
        F.when(ordered.isNotNull(), elapsed_minutes(ordered, F.col("ticket_created_ts")))
        .cast("int").alias("order_to_ticket_time_min"),
        F.col("first_response_breached").alias("sla_first_response_breached"),
        F.col("resolution_breached").alias("sla_resolution_breached"),
        money(F.col("refund_amount")).alias("refund_amount"),
        zero.alias("compensation_amount"),
        zero.alias("credit_amount"),
        money_or_zero(F.col("refund_amount")).alias("total_revenue_impact"),
        refund_pct(F.col("refund_amount"), F.col("total_amount")).alias("refund_impact_pct"),
        F.coalesce("total_event_count", F.lit(0)).cast("int").alias("total_event_count"),
        reopens.cast("int").alias("reopen_count"),
        (reopens > 0).alias("is_reopened"),
        F.lit(False).alias("is_escalated"),
        F.lit(batch_id).alias("batch_id"),
        *keep,
    )


def absent_tickets(tickets: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Tickets the fact does not hold yet."""
    known = tickets.filter(F.col("ticket_id").isNotNull())
    return known if existing is None else not_in_target(known, existing, ["ticket_id"])


def keys_in_use(existing: DataFrame | None) -> DataFrame | int:
    """The highest ticket key of the fact."""
    return 0 if existing is None else max_key(existing, "ticket_sk")


def new_tickets(tickets: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Tickets the fact does not hold yet, numbered after the highest ticket key in use, in ticket
    order. Narrowing and numbering come first: the later joins then only see new tickets."""
    return number_by_key(absent_tickets(tickets, existing), "ticket_id", "ticket_sk", keys_in_use(existing))


def to_fact_schema(rows: DataFrame) -> DataFrame:
    """Columns of the fact table in order; those no source fills are null."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in FACT_SCHEMA.fields
    ])
