"""Registered queries: the streaming cycle over the given tables as file sources."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import ColumnRule, FileContract, ForeignKey
from millrace.operators.loading import Lake
from millrace.operators.routing import WaitingRoom
from millrace.plans.daily import batch_room, load_batch_folder
from millrace.plans.logs import windowed_counts
from millrace.session import scratch_path, staged
from millrace.sources.standard_contracts import STANDARD, TICKET_EXTRAS
from millrace.streaming.cycle import CycleJob, FileLoader, StreamLoader, run_cycle, update_fact
from millrace.workload import model as m
from millrace.workload.loads import fresh_lake, in_credit


def stream_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table as an unbounded source of files. The path is a pattern because the source
    takes a folder or a pattern, and the table may be one file."""
    schema = m.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("latestFirst", False).parquet(f"{sf}/{name}.parque[t]")


def _orders(df: DataFrame) -> DataFrame:
    status, none = F.col("o_orderstatus"), F.lit(None).cast("string")
    return df.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        none.alias("restaurant_id"), none.alias("driver_id"), none.alias("region_id"),
        F.col("o_totalprice").alias("order_amount"), none.alias("delivery_fee"),
        none.alias("discount_amount"), F.col("o_totalprice").alias("total_amount"),
        none.alias("payment_method"),
        F.when(status == "O", "In Transit").when(status == "P", "Pending").otherwise("Delivered")
        .alias("order_status"), F.col("o_orderdate").alias("order_created_at"), none.alias("delivered_at"))


def _tickets(df: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return df.select(
        F.col("o_orderkey").cast("string").alias("ticket_id"), F.col("o_orderkey").cast("string").alias("order_id"),
        F.quarter("o_orderdate").alias("reason_id"),
        F.when(status == "F", F.col("o_totalprice")).when(status == "P", 0.0).alias("refund_amount"),
        F.when(status == "O", "Open").when(status == "P", "InProgress").when(status == "F", "Closed")
        .alias("status"), F.col("o_orderdate").alias("created_at"), F.col("o_custkey").alias("customer_id"))


EVENT_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _events(df: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("l_extendedprice", "l_quantity")]
    return df.select(
        F.concat_ws("-", *EVENT_ID, F.date_format("l_shipdate", "yyyyMMdd"), *cents).alias("event_id"),
        F.col("l_orderkey").cast("string").alias("ticket_id"), F.col("l_suppkey").alias("agent_id"),
        F.lit("Open").alias("old_status"),
        F.when(flag == "N", "InProgress").when(flag == "A", "Resolved").when(flag == "R", "Reopened")
        .alias("new_status"), F.col("l_shipdate").alias("event_ts"), F.lit("checked").alias("notes"))


def stream_cycle(spark, sf):
    """Orders, tickets and events streamed in write order; the fact built from what was loaded.

    Tickets with a refund of exactly 0 break the exclusive bound and go to quarantine.
    """
    lake, store = fresh_lake(spark, "cycle"), scratch_path(spark, "cycle-store")
    plan = [("orders", _orders, STANDARD["orders.json"], {}, {}),
            ("orders", _tickets, STANDARD["tickets.csv"], {"order_id": ("silver_orders", "order_id")},
             TICKET_EXTRAS),
            ("lineitem", _events, STANDARD["ticket_events.json"], {}, {})]
    for name, shape, contract, parents, extras in plan:
        loader = StreamLoader(lake, contract, store, parents, extras)
        loader.start(shape(stream_table(spark, sf, name))).awaitTermination()
    update_fact(lake, "cycle1")
    return lake.read("fact_ticket_lifecycle").select(
        "ticket_sk", "ticket_id", "order_id", "ticket_status", "order_status", "order_total_amount",
        "refund_amount", "refund_impact_pct", "total_event_count", "reopen_count", "is_reopened",
        "resolution_time_min", "sla_resolution_breached", "batch_id")


STREAM_CYCLE_SQL = """
with kept as (
    select *, cast(o_orderkey as varchar) as id from orders where o_orderstatus <> 'P'
),
ev as (
    select distinct cast(l_orderkey as varchar) as id, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           l_extendedprice, l_quantity, l_returnflag from lineitem
),
act as (
    select id, count(*) as n, count(*) filter (l_returnflag = 'R') as reopens,
           min(l_shipdate) filter (l_returnflag = 'A') as resolved from ev group by id
)
select row_number() over (order by k.id) as ticket_sk, k.id as ticket_id, k.id as order_id,
       case o_orderstatus when 'O' then 'Open' else 'Closed' end as ticket_status,
       case o_orderstatus when 'O' then 'In Transit' else 'Delivered' end as order_status,
       cast(o_totalprice as decimal(18,2)) as order_total_amount,
       case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end as refund_amount,
       cast(case when o_orderstatus = 'F' then 100 else 0 end as decimal(5,2)) as refund_impact_pct,
       cast(coalesce(n, 0) as integer) as total_event_count, cast(coalesce(reopens, 0) as integer) as reopen_count,
       coalesce(reopens, 0) > 0 as is_reopened,
       cast(case when resolved is not null then greatest(datediff('minute', o_orderdate, resolved), 0) end
            as integer) as resolution_time_min,
       case when resolved is not null then greatest(datediff('minute', o_orderdate, resolved), 0) > 15 end
           as sla_resolution_breached, 'cycle1' as batch_id
from kept k left join act a on a.id = k.id"""

PLAIN_ORDERS = FileContract("plain_orders.parquet", (
    ColumnRule("o_orderkey", "integer", pk=True, nullable=False),
    ColumnRule("o_custkey", "integer"),
    ColumnRule("o_orderstatus", "varchar"),
), "stream")


def stream_dedup(spark, sf):
    """The same files delivered to two runs: the second run inserts nothing."""
    lake = fresh_lake(spark, "dedup")
    columns = PLAIN_ORDERS.names
    for run in ("a", "b"):
        loader = StreamLoader(lake, PLAIN_ORDERS, scratch_path(spark, f"dedup-{run}"))
        loader.start(stream_table(spark, sf, "orders").select(*columns)).awaitTermination()
    return lake.read(PLAIN_ORDERS.silver_table)


def stream_repeats(spark, sf):
    """Three deliveries of all orders in files of their own, a delivery's files a batch: repeats end in the state store. Shows
    how many rows came, how many reached the load, and what Silver holds.

    Every batch validates, loads and passes over the state whatever it brings, so batches do not become more with the files."""
    lake, store = fresh_lake(spark, "repeats"), scratch_path(spark, "repeats-store")
    rows = m.table(spark, sf, "orders").select(*PLAIN_ORDERS.names)
    root = scratch_path(spark, "deliveries")
    for delivery in range(3):
        rows.write.parquet(f"{root}/delivery={delivery}")
    files = len(spark.read.schema(rows.schema).parquet(f"{root}/delivery=0").inputFiles())
    loader = StreamLoader(lake, PLAIN_ORDERS, store, repeats_within="1 day")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, files)).parquet(f"{root}/*")
    loader.start(source.select(*PLAIN_ORDERS.names)).awaitTermination()
    passed = spark.read.parquet(f"{store}/bronze/{PLAIN_ORDERS.stem}/batch=*").agg(F.count(F.lit(1)).alias("n"))
    came = spark.read.parquet(f"{root}/*").agg(F.count(F.lit(1)).alias("n"))
    return lake.read(loader.table).agg(F.count(F.lit(1)).alias("loaded")).select(
        came.scalar().alias("came"), passed.scalar().alias("passed"), "loaded")


def stream_orphan_retry(spark, sf):
    """Orders of customers not known yet wait; after the customers arrive the next cycle takes them in, without new
    files. Shows what each step left in Silver and in the waiting room."""
    lake, store = fresh_lake(spark, "late"), scratch_path(spark, "late-store")
    everyone = m.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    lake.refresh("silver_customer", in_credit(everyone))
    loader = StreamLoader(lake, PLAIN_ORDERS, store, {"o_custkey": ("silver_customer", "c_custkey")})
    source = stream_table(spark, sf, "orders").select(*PLAIN_ORDERS.names)
    run_cycle([(loader, source)], lake, "c0")

    def standing(step: int) -> DataFrame:
        waiting = loader.waiting_at(loader.last_cycle()).agg(F.count(F.lit(1)))
        return lake.read(loader.table).agg(F.count(F.lit(1)).alias("loaded")).select(
            F.lit(step).alias("step"), "loaded", waiting.scalar().alias("waiting"))

    first = staged(standing(0), "standing")
    lake.refresh("silver_customer", everyone)
    run_cycle([(loader, source)], lake, "c1")
    return first.unionByName(standing(1))


STREAM_ORPHAN_SQL = """
with n as (
    select count(*) as everything,
           count(*) filter (o_custkey in (select c_custkey from customer where c_acctbal >= 0)) as known
    from orders
)
select cast(0 as integer) as step, known as loaded, everything - known as waiting from n
union all select cast(1 as integer), everything, cast(0 as bigint) from n"""


# ---- streams of files, judged one by one -------------------------------------------------------

CUSTOMER_FILES = FileContract("customers.csv", (
    ColumnRule("c_custkey", "integer", pk=True, nullable=False),
    ColumnRule("c_name", "varchar"),
    ColumnRule("c_acctbal", "float"),
), "stream")


def delivered_customers(spark: SparkSession, sf: str) -> str:
    """Customers as CSV files in three hours: hour 1 in the contract's order of columns, hour 2 in another one with a further
    column, hour 3 without the balance."""
    root = scratch_path(spark, "customer-files")
    kept = m.table(spark, sf, "customer").select(
        F.pmod("c_custkey", F.lit(3)).alias("part"), "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    orders = [["c_custkey", "c_name", "c_acctbal"], ["c_acctbal", "c_mktsegment", "c_name", "c_custkey"], ["c_custkey", "c_name"]]
    for hour, columns in enumerate(orders, 1):
        kept.filter(F.col("part") == hour - 1).select(*columns).write.csv(f"{root}/2024-01-05/{hour:02d}/customers.csv", header=True)
    return root


def customer_loader(spark: SparkSession, label: str) -> FileLoader:
    return FileLoader(fresh_lake(spark, label), CUSTOMER_FILES, scratch_path(spark, f"{label}-store"),
                      pattern="customers.csv/part-*.csv")


def stream_mixed_headers(spark, sf):
    """Files with two orders of columns and files that lack one: the rows of the good ones, under their own names."""
    loader = customer_loader(spark, "mixed")
    loader.start(loader.arriving(delivered_customers(spark, sf), "*/*/customers.csv")).awaitTermination()
    return loader.lake.read(loader.table)


def stream_file_ledger(spark, sf):
    """The same files delivered to five runs: good ones are loaded once, bad ones tried three times. One row an outcome:
    rows loaded, most attempts of a file, and what Silver holds in the end."""
    loader, root = customer_loader(spark, "ledger"), delivered_customers(spark, sf)
    files = spark.read.format("binaryFile").load(f"{root}/*/*/customers.csv").select("path", "length").collect()
    for run in range(5):
        loader.load_files([(f.path, str(f.length)) for f in files], f"run-{run}", run)
    tries = loader.ledger.state().groupBy("file_path").agg(
        F.sum("attempt_count").alias("attempts"), F.sum("record_count").alias("records"), F.max("current_stage").alias("current_stage"))
    errors = loader.ledger.events().filter("error is not null").select("file_path", "error").distinct()
    return tries.join(errors, "file_path", "left").groupBy("current_stage", "error").agg(
        F.sum("records").alias("records"), F.max("attempts").alias("attempts")).withColumn(
        "loaded", loader.lake.read(loader.table).agg(F.count(F.lit(1)).alias("n")).scalar())


STREAM_LEDGER_SQL = """
with n as (select count(*) as good from customer where c_custkey % 3 < 2)
select 'VALIDATED' as current_stage, cast(null as varchar) as error, good as records, cast(1 as bigint) as attempts, good as loaded from n
union all
select 'FAILED_SCHEMA', 'column_mismatch: c_acctbal', cast(0 as bigint), cast(3 as bigint), good from n"""

ORDER_FILES = FileContract("plain_orders.csv", (
    ColumnRule("o_orderkey", "integer", pk=True, nullable=False),
    ColumnRule("o_custkey", "integer", fk=ForeignKey("o_custkey", "c_custkey", "customer.csv")),
    ColumnRule("o_orderstatus", "varchar"),
), "batch")
PATIENCE = 300  # seconds


def delivered_orders(spark: SparkSession, sf: str, folder: str) -> str:
    root = scratch_path(spark, "order-files")
    m.table(spark, sf, "orders").select(*ORDER_FILES.names).write.csv(f"{root}/{folder}plain_orders.csv", header=True)
    return root


def _standing(lake: Lake, room: WaitingRoom, step: int) -> DataFrame:
    """Rows in Silver and in the waiting room, written down."""
    waiting = room.left_by(room.last()).agg(F.count(F.lit(1)).alias("n"))
    return staged(lake.read("silver_plain_orders").agg(F.count(F.lit(1)).alias("loaded")).select(
        F.lit(step).alias("step"), "loaded", waiting.scalar().alias("waiting")), "standing")


def polling_cycle(spark, sf):
    """A polling job over order files. Customers in debt become known while it runs; the next tick takes their orders in,
    without a new file. Shows what there was before and after."""
    lake, store = fresh_lake(spark, "polling"), scratch_path(spark, "polling-store")
    everyone = m.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    lake.refresh("silver_customer", in_credit(everyone))
    loader = FileLoader(lake, ORDER_FILES, store, {"o_custkey": ("silver_customer", "c_custkey")}, max_retries=1_000_000,
                        pattern="plain_orders.csv/part-*.csv")
    query = CycleJob(lake, [loader], store).start(delivered_orders(spark, sf, "2024-01-05/08/"), "1 second", "*/*/plain_orders.csv")

    def wait_until(done) -> None:
        ends = time.monotonic() + PATIENCE
        while not done():
            if query.exception() or not query.isActive or time.monotonic() > ends:
                raise RuntimeError(f"the polling job did not get there: {query.exception()}")
            time.sleep(0.5)

    try:
        wait_until(lambda: loader.last_cycle() >= 0)
        first = _standing(lake, loader.room, 0)
        lake.refresh("silver_customer", everyone)
        wait_until(lambda: loader.waiting_at(loader.last_cycle()).isEmpty())
    finally:
        query.stop()
    return first.unionByName(_standing(lake, loader.room, 1))


def batch_orphan_retry(spark, sf):
    """Batch counterpart of ``stream_orphan_retry``: the same unchanged files in a second run, after the parents came."""
    lake, store = fresh_lake(spark, "late-batch"), scratch_path(spark, "late-batch-store")
    everyone = m.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    folder = delivered_orders(spark, sf, "")
    steps = []
    for step, known in enumerate((in_credit(everyone), everyone)):
        lake.refresh("silver_customer", known)
        load_batch_folder(lake, folder, [ORDER_FILES], store, f"run-{step}", "2024-01-05")
        steps.append(_standing(lake, batch_room(lake, store, ORDER_FILES), step))
    return steps[0].unionByName(steps[1])


def stream_minutes(spark, sf):
    """Events per minute as a streaming aggregation; the sink keeps the complete result."""
    path = scratch_path(spark, "minutes")
    counts = windowed_counts(stream_table(spark, sf, "events").select("ts"), "ts")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (counts.writeStream.outputMode("complete").foreachBatch(keep)
             .option("checkpointLocation", scratch_path(spark, "minutes-cp"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(path).select(F.col("minute").cast("timestamp_ntz").alias("minute"), "count")


QUERIES: dict[str, tuple[m.Query, str | None]] = {
    "stream_cycle": (stream_cycle, STREAM_CYCLE_SQL),
    "stream_dedup": (stream_dedup, "select o_orderkey, o_custkey, o_orderstatus from orders"),
    "stream_orphan_retry": (stream_orphan_retry, STREAM_ORPHAN_SQL),
    "stream_repeats": (stream_repeats, "select 3 * count(*) as came, count(*) as passed, count(*) as loaded from orders"),
    "stream_mixed_headers": (
        stream_mixed_headers, "select c_custkey, c_name, c_acctbal from customer where c_custkey % 3 < 2"),
    "stream_file_ledger": (stream_file_ledger, STREAM_LEDGER_SQL),
    "polling_cycle": (polling_cycle, STREAM_ORPHAN_SQL),
    "batch_orphan_retry": (batch_orphan_retry, STREAM_ORPHAN_SQL),
    "stream_minutes": (
        stream_minutes,
        "select date_trunc('minute', ts) as minute, count(*) as count from events group by 1"),
}
