"""The given tables in the roles of the ticket domain.

ticket = ``orders``; ticket event = ``lineitem`` (return flag N, A, R = in progress, resolved,
reopened); restaurant and driver of a ticket = lowest and highest ``l_suppkey`` of its events;
city = region name; customer = ``customer``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.plans.sla import ticket_activity

Query = Callable[[SparkSession, str], DataFrame]

# limits in minutes that split the given dates well: 180 and 365 days
RESPONSE_LIMIT, RESOLUTION_LIMIT = 259_200, 525_600


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables. Its footer is read once per process; a query that uses a table
    several times then plans without further footer jobs."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def ticket_events(spark: SparkSession, sf: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_suppkey").alias("agent_id"),
        F.when(line == "O", "Open").otherwise("Closed").alias("old_status"),
        F.when(flag == "N", "InProgress").when(flag == "A", "Resolved").otherwise("Reopened")
        .alias("new_status"),
        F.col("l_shipdate").alias("event_ts"),
        F.when(F.col("l_linenumber") == 7, "Agent responded to the customer").alias("notes"),
    )


EVENTS_SQL = """
ev as (
    select l_orderkey as ticket_id, l_suppkey as agent_id,
           case when l_linestatus = 'O' then 'Open' else 'Closed' end as old_status,
           case l_returnflag when 'N' then 'InProgress' when 'A' then 'Resolved' else 'Reopened' end
               as new_status,
           l_shipdate as event_ts,
           case when l_linenumber = 7 then 'Agent responded to the customer' end as notes
    from lineitem
)"""


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "O", "Open").when(status == "P", "InProgress").otherwise("Closed")
        .alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_id"),
        (F.weekday("o_orderdate") + 21).cast("bigint").alias("channel_id"),
        F.quarter("o_orderdate").cast("bigint").alias("reason_id"),
        F.when(status == "F", F.col("o_totalprice")).when(status == "P", 0.0).alias("refund_amount"),
        F.col("o_orderdate").alias("created_at"),
    )


TICKETS_SQL = """
tk as (
    select o_orderkey as ticket_id, o_orderkey as order_id, o_custkey as customer_id,
           case o_orderstatus when 'O' then 'Open' when 'P' then 'InProgress' else 'Closed' end
               as status,
           cast(substr(o_orderpriority, 1, 1) as bigint) as priority_id,
           cast(isodow(o_orderdate) + 20 as bigint) as channel_id,
           cast(quarter(o_orderdate) as bigint) as reason_id,
           case o_orderstatus when 'F' then o_totalprice when 'P' then 0.0 end as refund_amount,
           o_orderdate as created_at
    from orders
)"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(status == "O", "In Transit").when(status == "P", "Pending").otherwise("Delivered")
        .alias("order_status"),
        F.col("o_totalprice").alias("order_amount"),
        F.lit(0.0).alias("discount_amount"),
        F.lit(None).cast("double").alias("delivery_fee"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("order_created_at"),
        F.lit(None).cast("timestamp_ntz").alias("delivered_at"),
    )


ORDERS_SQL = """
od as (
    select o_orderkey as order_id,
           case o_orderstatus when 'O' then 'In Transit' when 'P' then 'Pending' else 'Delivered' end
               as order_status,
           o_totalprice as order_amount, 0.0 as discount_amount,
           cast(null as double) as delivery_fee, o_totalprice as total_amount,
           o_orderdate as order_created_at
    from orders
)"""


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """Per-ticket rollup with the ticket's restaurant and driver."""
    return ticket_activity(ticket_events(spark, sf), {
        "restaurant_id": F.min("agent_id"), "driver_id": F.max("agent_id")})


# One pass over a ticket's events; the rest is arithmetic on its moments.
ACTIVITY_SQL = """
life as (
    select ticket_id, count(*) as total_event_count,
           count(*) filter (where 'reopened' in (lower(old_status), lower(new_status))) as reopen_count,
           min(event_ts) filter (where lower(new_status) = 'inprogress' or notes ilike '%agent responded%') as answered,
           min(event_ts) filter (where lower(new_status) = 'resolved') as solved,
           min(event_ts) filter (where lower(new_status) = 'reopened') as reopened_ts,
           max(event_ts) as last_seen,
           min(agent_id) as restaurant_id, max(agent_id) as driver_id
    from ev group by ticket_id
)"""

TIMING_SQL = f"""
waits as (
    select tk.ticket_id, tk.order_id, tk.created_at, answered, solved, coalesce(last_seen > solved, false) as back,
           greatest(datediff('minute', tk.created_at, answered), 0) as to_answer,
           greatest(datediff('minute', tk.created_at, solved), 0) as to_solve
    from tk left join life using (ticket_id)
),
timing as (
    select ticket_id, order_id, created_at as ticket_created_ts, answered as first_response_ts,
           solved as resolved_ts,
           cast(if(answered is null, null, to_answer) as bigint) as first_response_time,
           cast(if(solved is null, null, to_solve) as bigint) as resolution_time,
           if(answered is null, null, to_answer > {RESPONSE_LIMIT}) as first_response_breached,
           if(solved is null, null, to_solve > {RESOLUTION_LIMIT}) as resolution_breached,
           back as is_reopened
    from waits
)"""


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nation with its region: 25 rows at any scale."""
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")


def outlets(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """Suppliers as restaurants or drivers, keyed by ``key``."""
    return table(spark, sf, "supplier").join(
        places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias(key), F.col("s_name").alias("restaurant_name"),
        F.col("r_name").alias("city_name"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(
        places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_sk"), F.col("r_name").alias("city_name"))


def channels(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as channels; tickets name keys 21 to 27, so some have no channel."""
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("channel_id"), F.col("n_name").alias("channel_name"))


def priorities(spark: SparkSession, sf: str) -> DataFrame:
    code = F.substring("o_orderpriority", 1, 1)
    return (table(spark, sf, "orders").select("o_orderpriority").distinct().select(
        code.cast("bigint").alias("priority_id"), code.alias("priority_code"),
        F.substring("o_orderpriority", 3, 100).alias("priority_name"),
        (code.cast("bigint") * 43_200).alias("sla_first_response_min"),
        (code.cast("bigint") * 86_400).alias("sla_resolution_min")))


def reasons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").cast("bigint").alias("reason_id"), F.col("r_name").alias("reason_name"))


DIMS_SQL = """
place as (select n_nationkey, n_name, r_name from nation left join region on n_regionkey = r_regionkey),
outlet as (
    select s_suppkey as sk, s_name as restaurant_name, r_name as city_name
    from supplier left join place on s_nationkey = n_nationkey
),
cust as (select c_custkey as sk, r_name as city_name from customer left join place on c_nationkey = n_nationkey),
chan as (select cast(n_nationkey as bigint) as sk, n_name as channel_name from nation),
prio as (
    select distinct cast(substr(o_orderpriority, 1, 1) as bigint) as sk,
           substr(o_orderpriority, 3) as priority_name
    from orders
),
reas as (select cast(r_regionkey as bigint) as sk, r_name as reason_name from region)"""


def dims(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Dimensions keyed by their natural key (the numbering queries assign real keys)."""
    return {
        "customer": customers(spark, sf),
        "driver": outlets(spark, sf, "driver_sk"),
        "restaurant": outlets(spark, sf, "restaurant_sk"),
        "channel": channels(spark, sf).withColumnRenamed("channel_id", "channel_sk"),
        "priority": priorities(spark, sf).withColumnRenamed("priority_id", "priority_sk"),
        "reason": reasons(spark, sf).withColumnRenamed("reason_id", "reason_sk"),
    }


FACT_SQL = """
fact as (
    select t.ticket_id + 1 as ticket_sk, t.ticket_id, t.order_id,
           t.customer_id as customer_sk, c.driver_id as driver_sk, c.restaurant_id as restaurant_sk,
           t.channel_id as channel_sk, t.priority_id as priority_sk, t.reason_id as reason_sk,
           t.status as ticket_status, o.order_status,
           cast(t.refund_amount as decimal(18,2)) as refund_amount,
           cast(0 as decimal(18,2)) as compensation_amount,
           cast(0 as decimal(18,2)) as credit_amount,
           cast(coalesce(t.refund_amount, 0) as decimal(18,2)) as total_revenue_impact,
           coalesce(c.total_event_count, 0) as total_event_count,
           coalesce(c.reopen_count, 0) as reopen_count,
           coalesce(c.reopen_count, 0) > 0 as is_reopened,
           o.order_created_at, t.created_at, o.total_amount
    from tk t
    left join od o on o.order_id = t.order_id
    left join life c on c.ticket_id = t.ticket_id
)"""

PREFIX = "with " + ",".join([EVENTS_SQL, TICKETS_SQL, ORDERS_SQL, ACTIVITY_SQL, TIMING_SQL, FACT_SQL,
                             DIMS_SQL])


def pct_sql(part: str, whole: str) -> str:
    """Half-up percentage with two decimals from integer counts, exact in any engine."""
    return (f"case when {whole} = 0 then null else "
            f"cast((cast({part} as bigint) * 20000 + {whole}) // (2 * {whole}) as double) / 100 end")


def mean_sql(total: str, n: str, scale: int = 1) -> str:
    """Half-up mean with two decimals of non-negative integers (``scale`` 100 for cents)."""
    up = 200 // scale
    return (f"case when {n} = 0 then null else "
            f"cast((cast({total} as bigint) * {up} + {n}) // (2 * {n}) as double) / 100 end")
