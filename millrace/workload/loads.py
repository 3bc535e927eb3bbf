"""Registered queries: personal data, table loads, file formats, tracking, dimensions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.masking import hash_columns, mask_columns, pii_hash
from millrace.operators import tracking
from millrace.operators.keys import stable_keys
from millrace.operators.loading import Lake, insert_if_absent, upsert
from millrace.operators.validation import validate
from millrace.plans import dimensions as d
from millrace.session import scratch_path
from millrace.sources import files
from millrace.workload import model as m
from millrace.workload.checks import (
    CUSTOMERS, CUSTOMERS_CHECKED_SQL, customers_text, shown,
)


def fresh_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, scratch_path(spark, label), f"millrace_{uuid.uuid4().hex[:12]}")


# ---- personal data ----------------------------------------------------------------------------

def pii_hashed(spark, sf):
    return hash_columns(m.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                        ["C_NAME"])


def pii_masks(spark, sf):
    base = m.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("secret"), F.col("c_name").alias("card"),
        F.substring("c_mktsegment", 1, 4).alias("short"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), "c_mktsegment",
        F.substring("c_name", -2, 2).alias("tiny"))
    return mask_columns(base, {
        "secret": "redact", "email": "partial_email", "c_mktsegment": "partial_prefix_3",
        "card": "last_four", "short": "last_four", "tiny": "partial_prefix_3", "absent": "redact"})


PII_MASKS_SQL = r"""
select c_custkey, '[REDACTED]' as secret, '************' || right(c_name, 4) as card,
       '************' || substr(c_mktsegment, 1, 4) as short, '***@example.com' as email,
       substr(c_mktsegment, 1, 3) || '********' as c_mktsegment, right(c_name, 2) as tiny
from customer"""


def text_hashes(spark, sf):
    """Content hashes of whole documents, as MD5 and SHA-256, and with the part before @ masked."""
    return m.table(spark, sf, "documents").select(
        "doc_id", pii_hash(F.col("text")).alias("md5"), F.sha2("text", 256).alias("sha256"),
        F.md5(F.regexp_replace("text", r"^[^@]+", "***")).alias("masked_md5"))


# ---- loads ------------------------------------------------------------------------------------

def customer_rows(spark, sf):
    return m.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def in_credit(df: DataFrame) -> DataFrame:
    return df.filter("c_acctbal >= 0")


def insert_absent_rows(spark, sf):
    """Rows a load would append when customers in credit are there and all arrive twice."""
    everyone = customer_rows(spark, sf)
    return insert_if_absent(everyone.unionByName(everyone), in_credit(everyone), ["c_custkey"])


def upsert_rows(spark, sf):
    """Old segments of customers in credit overwritten by a delivery of balances under 5000."""
    everyone = customer_rows(spark, sf)
    old = in_credit(everyone).withColumn("c_mktsegment", F.lit("OLD"))
    return upsert(everyone.filter("c_acctbal < 5000"), old, ["c_custkey"])


UPSERT_SQL = """
select c_custkey, c_name, case when c_acctbal < 5000 then c_mktsegment else 'OLD' end as c_mktsegment,
       c_acctbal from customer"""


def silver_refresh(spark, sf):
    lake = fresh_lake(spark, "refresh")
    lake.refresh("silver_customers", in_credit(customer_rows(spark, sf)))
    lake.refresh("silver_customers", customer_rows(spark, sf))
    return lake.read("silver_customers")


def silver_insert(spark, sf):
    """First load, then the same file again, then the full file: every key once."""
    lake = fresh_lake(spark, "insert")
    everyone = customer_rows(spark, sf)
    for batch in (in_credit(everyone), in_credit(everyone), everyone):
        lake.insert_absent("silver_customers", batch, ["c_custkey"])
    return lake.read("silver_customers")


def silver_append(spark, sf):
    """Without a key every delivery is appended."""
    lake = fresh_lake(spark, "append")
    for _ in range(2):
        lake.insert_absent("silver_regions", m.table(spark, sf, "orders").select("o_orderkey"), [])
    return lake.read("silver_regions").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


def load_metrics(spark, sf):
    lake = fresh_lake(spark, "metrics")
    everyone = customer_rows(spark, sf)
    results = [lake.insert_absent("silver_customers", b, ["c_custkey"])
               for b in (in_credit(everyone), everyone)]
    return spark.createDataFrame(
        [(i, r.attempted, r.inserted, r.skipped) for i, r in enumerate(results)],
        "load int, attempted bigint, inserted bigint, skipped bigint")


LOAD_METRICS_SQL = """
with n as (select count(*) as everyone, count(*) filter (c_acctbal >= 0) as credit from customer)
select cast(0 as integer) as load, credit as attempted, credit as inserted, cast(0 as bigint) as skipped from n
union all select cast(1 as integer), everyone, everyone - credit, credit from n"""


def gold_upsert(spark, sf):
    lake = fresh_lake(spark, "gold")
    everyone = customer_rows(spark, sf)
    lake.upsert("dim_customer", in_credit(everyone).withColumn("c_mktsegment", F.lit("OLD")), ["c_custkey"])
    lake.upsert("dim_customer", everyone.filter("c_acctbal < 5000"), ["c_custkey"])
    return lake.read("dim_customer")


def gold_insert_ignore(spark, sf):
    lake = fresh_lake(spark, "ignore")
    everyone = customer_rows(spark, sf)
    lake.refresh("fact", in_credit(everyone).withColumn("c_mktsegment", F.lit("OLD")))
    lake.insert_ignore("fact", everyone, ["c_custkey"])
    return lake.read("fact")


# ---- file formats -----------------------------------------------------------------------------

def csv_scan(spark, sf):
    """Customer text written as CSV, scanned by contract and validated."""
    path = scratch_path(spark, "csv")
    customers_text(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    raw = files.read_source(spark, path, CUSTOMERS, fmt="csv")
    return shown(validate(raw, CUSTOMERS))


def json_scan(spark, sf):
    path = scratch_path(spark, "json")
    customers_text(spark, sf).write.json(path)
    raw = files.read_source(spark, path, CUSTOMERS, fmt="json", array=False,
                            schema=CUSTOMERS.read_schema())
    return shown(validate(raw, CUSTOMERS))


def mixed_headers(spark, sf):
    """Customers in several CSV files whose headers differ in order, read back as one table."""
    path = scratch_path(spark, "mixed")
    people = m.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    split = people.withColumn("part", F.pmod("c_custkey", F.lit(3)))
    for part, columns in enumerate((("c_custkey", "c_name", "c_mktsegment"), ("c_mktsegment", "c_custkey", "c_name"),
                                    ("c_name", "c_mktsegment", "c_custkey"))):
        split.filter(F.col("part") == part).select(*columns).write.option("header", True).csv(f"{path}/part={part}")
    return files.read_csv(spark, f"{path}/part=*/*.csv").select("c_custkey", "c_name", "c_mktsegment")


def bronze_archive(spark, sf):
    """Events archived by date and quarter of the day, and the whole archive read back."""
    path = scratch_path(spark, "bronze")
    ev = m.table(spark, sf, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("date"),
        (F.floor(F.hour("ts") / 6) * 6).cast("int").alias("hour"))
    files.archive_raw(ev, path)
    stored = spark.read.parquet(path)
    return stored.select("event_id", "event_type", F.col("date").cast("date").alias("date"), "hour")


def null_tokens(spark, sf):
    """Spellings of "no value" become null in the chosen text columns."""
    od = m.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "N/A").when(F.col("o_orderstatus") == "P", " NULL ")
        .otherwise(F.col("o_orderpriority")).alias("priority"), "o_orderstatus")
    return files.clean_nulls(od, files.rules.NULL_TOKENS)


# ---- tracking ---------------------------------------------------------------------------------

def _arrived(spark, sf):
    """One file per user: its content hash is over the number of events."""
    per = m.table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("file_path"),
                      F.md5(F.col("n").cast("string")).alias("last_hash"))


def _tracked(spark, sf):
    """Earlier runs, by user number modulo 8: 0 and 1 were done, 2 done with other content, 3 and 4 failed once,
    5 and 6 failed three times, 7 was never seen."""
    per = m.table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "kind", F.pmod("user_id", F.lit(8))).filter(F.col("kind") < 7)
    then = F.when(F.col("kind") == 2, F.col("n") + 1).otherwise(F.col("n"))
    return per.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("file_path"),
        F.lit("run0").alias("pipeline_run_id"), F.lit("2024-01-01").cast("timestamp").alias("processed_at"),
        F.when(F.col("kind") < 3, "SUCCESS").otherwise("FAILED").alias("status"), F.lit("PENDING").alias("current_stage"),
        F.lit(0).alias("record_count"), F.md5(then.cast("string")).alias("last_hash"),
        F.lit(None).cast("string").alias("last_checkpoint"), F.lit(0).alias("retry_num"),
        F.when(F.col("kind") > 4, 3).otherwise(1).alias("attempt_count"))


def files_due(spark, sf):
    return tracking.acquirable(_arrived(spark, sf), _tracked(spark, sf), 3).select("file_path")


def tracking_after(spark, sf):
    """Tracking after the due files were taken by a run and all succeeded."""
    due = tracking.acquirable(_arrived(spark, sf), _tracked(spark, sf), 3)
    taken = tracking.acquire(_tracked(spark, sf), due, "run1")
    told = due.select("file_path", F.lit("SUCCESS").alias("status"), F.lit("VALIDATED").alias("current_stage"))
    marked = tracking.mark(taken, told, "run1")
    return tracking.latest_stage(marked)


FILES_SQL = """
per as (select distinct user_id, 'user-' || user_id as file_path, user_id % 8 as kind from events)"""


# ---- dimensions -------------------------------------------------------------------------------

def _geo(spark, sf):
    regions = m.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("region_id"), F.col("n_name").alias("region_name"),
        F.col("n_regionkey").cast("bigint").alias("city_id"),
        (F.col("n_nationkey") + 0.5).alias("delivery_base_fee"))
    cities = m.table(spark, sf, "region").select(
        F.col("r_regionkey").cast("bigint").alias("city_id"), F.col("r_name").alias("city_name"),
        F.lit("EG").alias("country"), F.lit("Africa/Cairo").alias("timezone"))
    return regions, cities


GEO_SQL = """
geo as (
    select n_nationkey, n_name as region_name, r_name as city_name, 'EG' as country,
           'Africa/Cairo' as timezone, cast(n_nationkey + 0.5 as decimal(18,2)) as delivery_base_fee
    from nation left join region on n_regionkey = r_regionkey
)"""


def _segments(spark, sf):
    return m.table(spark, sf, "customer").select("c_mktsegment").distinct().select(
        F.col("c_mktsegment").alias("segment_id"), F.initcap("c_mktsegment").alias("segment_name"),
        F.length("c_mktsegment").cast("double").alias("discount_pct"),
        (F.length("c_mktsegment") > 8).alias("priority_support"))


def dim_customer(spark, sf):
    regions, cities = _geo(spark, sf)
    people = m.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"), F.col("c_nationkey").cast("bigint").alias("region_id"),
        F.col("c_mktsegment").alias("segment_id"), F.lit("2024-01-15").cast("timestamp_ntz").alias("signup_date"),
        F.lit("female").alias("gender"))
    return d.dim_customer(people, regions, cities, _segments(spark, sf)).drop("row_effective_ts")


DIM_CUSTOMER_SQL = "with " + GEO_SQL + """
select row_number() over (order by c_custkey) as customer_sk, c_custkey as customer_id,
       md5(c_name) as hashed_full_name, md5(lower(c_name) || '@example.com') as hashed_email,
       cast(null as varchar) as hashed_phone, 'female' as gender, date '2024-01-15' as signup_date,
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) as segment_name,
       cast(length(c_mktsegment) as integer) as segment_discount_pct,
       length(c_mktsegment) > 8 as segment_priority_support, city_name, region_name, country, timezone,
       delivery_base_fee, true as is_active
from customer left join geo on c_nationkey = n_nationkey"""


def _outlets(spark, sf):
    return m.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("region_id"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        F.lit("2024-01-15").cast("timestamp_ntz").alias("hire_date"))


def dim_driver(spark, sf):
    regions, cities = _geo(spark, sf)
    drivers = _outlets(spark, sf).select(
        F.col("id").alias("driver_id"), F.col("name").alias("driver_name"),
        F.lit("01000000000").alias("driver_phone"), F.col("name").alias("national_id"), "region_id",
        F.lit("night").alias("shift"), F.lit("bike").alias("vehicle_type"), "hire_date",
        F.lit(4.25).alias("rating_avg"), F.lit(0.5).alias("on_time_rate"), F.lit(0.25).alias("cancel_rate"),
        F.col("id").alias("completed_deliveries"), "is_active")
    return d.dim_driver(drivers, regions, cities).drop("row_effective_ts")


DIM_DRIVER_SQL = "with " + GEO_SQL + """
select row_number() over (order by s_suppkey) as driver_sk, s_suppkey as driver_id,
       md5(s_name) as hashed_driver_name, md5('01000000000') as hashed_driver_phone,
       md5(s_name) as hashed_national_id, 'night' as shift, 'bike' as vehicle_type,
       date '2024-01-15' as hire_date, cast(4.25 as decimal(3,2)) as rating_avg,
       cast(0.5 as decimal(5,2)) as on_time_rate, cast(0.25 as decimal(5,2)) as cancel_rate,
       cast(s_suppkey as integer) as completed_deliveries, s_acctbal > 0 as is_active, city_name,
       region_name, country, timezone, delivery_base_fee
from supplier left join geo on s_nationkey = n_nationkey"""


def dim_restaurant(spark, sf):
    regions, cities = _geo(spark, sf)
    kinds = m.table(spark, sf, "region").select(
        F.col("r_regionkey").cast("bigint").alias("category_id"), F.col("r_name").alias("category_name"))
    places = _outlets(spark, sf).select(
        F.col("id").alias("restaurant_id"), F.col("name").alias("restaurant_name"), "region_id",
        F.length("name").cast("bigint").alias("category_id"), F.lit("Mid").alias("price_tier"),
        F.lit(3.5).alias("rating_avg"), F.lit(20).cast("bigint").alias("prep_time_avg_min"), "is_active")
    return d.dim_restaurant(places, kinds, regions, cities).drop("row_effective_ts")


DIM_RESTAURANT_SQL = "with " + GEO_SQL + """
select row_number() over (order by s_suppkey) as restaurant_sk, s_suppkey as restaurant_id,
       s_name as restaurant_name, k.r_name as category_name, 'Mid' as price_tier,
       cast(3.5 as decimal(3,2)) as rating_avg, cast(20 as integer) as prep_time_avg_min,
       s_acctbal > 0 as is_active, city_name, region_name, country, timezone, delivery_base_fee
from supplier left join geo on s_nationkey = n_nationkey left join region k on k.r_regionkey = length(s_name)"""


def dim_agent(spark, sf):
    teams = m.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("team_id"), F.col("n_name").alias("team_name"))
    agents = _outlets(spark, sf).select(
        F.col("id").alias("agent_id"), F.col("name").alias("agent_name"), F.col("name").alias("agent_email"),
        F.col("name").alias("agent_phone"), F.col("region_id").alias("team_id"),
        F.lit("Lead").alias("skill_level"), "hire_date", F.lit(9).cast("bigint").alias("avg_handle_time_min"),
        F.lit(0.75).alias("resolution_rate"), F.lit(4.5).alias("csat_score"), "is_active")
    return d.dim_agent(agents, teams).drop("row_effective_ts")


DIM_AGENT_SQL = """
select row_number() over (order by s_suppkey) as agent_sk, s_suppkey as agent_id,
       md5(s_name) as hashed_agent_name, md5(s_name) as hashed_agent_email,
       md5(s_name) as hashed_agent_phone, 'Lead' as skill_level, date '2024-01-15' as hire_date,
       cast(9 as integer) as avg_handle_time_min, cast(0.75 as decimal(5,2)) as resolution_rate,
       cast(4.5 as decimal(3,2)) as csat_score, s_acctbal > 0 as is_active, n_name as team_name
from supplier left join nation on s_nationkey = n_nationkey"""


def dim_reason(spark, sf):
    """Parts as reasons, brands as their categories."""
    parts = m.table(spark, sf, "part")
    kinds = parts.select("p_brand").distinct().select(
        F.col("p_brand").alias("reason_category_id"), F.upper("p_brand").alias("category_name"))
    reasons = parts.select(
        F.col("p_partkey").alias("reason_id"), F.col("p_name").alias("reason_name"),
        F.col("p_brand").alias("reason_category_id"), F.col("p_size").cast("bigint").alias("severity_level"),
        F.lit(0.5).alias("typical_refund_pct"))
    return d.dim_reason(reasons, kinds)


DIM_REASON_SQL = """
select row_number() over (order by p_partkey) as reason_sk, p_partkey as reason_id, p_name as reason_name,
       upper(p_brand) as reason_category_name, cast(p_size as integer) as severity_level,
       cast(0.5 as decimal(5,2)) as typical_refund_pct from part"""


def dim_date(spark, sf):
    """Every day between the first and last order; days with over 9 orders are called holidays."""
    days = m.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    span = days.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    busy = days.groupBy("full_date").agg(F.count(F.lit(1)).alias("n")).filter("n > 9")
    return d.dim_date(span, busy, fiscal_period=F.concat(F.lit("FY"), F.year("full_date").cast("string")))


DIM_DATE_SQL = """
with span as (select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders),
days as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as full_date from span),
busy as (select cast(o_orderdate as date) as full_date from orders group by 1 having count(*) > 9)
select cast(strftime(full_date, '%Y%m%d') as integer) as date_sk, full_date,
       cast(isodow(full_date) as integer) as day_of_week, strftime(full_date, '%A') as day_name,
       cast(day(full_date) as integer) as day_of_month, cast(week(full_date) as integer) as week_of_year,
       cast(month(full_date) as integer) as month_number, strftime(full_date, '%B') as month_name,
       cast(quarter(full_date) as integer) as quarter, cast(year(full_date) as integer) as year,
       isodow(full_date) >= 6 as is_weekend, 'FY' || year(full_date) as fiscal_period,
       b.full_date is not null as is_egyptian_holiday
from days left join busy b using (full_date)"""


def dim_time(spark, sf):
    """Minutes of the day with the events that fell on them."""
    day = d.dim_time(spark, {"morning": (6, 11), "afternoon": (12, 17), "evening": (18, 23)}, (12, 13, 19, 20))
    hits = m.table(spark, sf, "events").groupBy(
        (F.hour("ts") * 60 + F.minute("ts")).alias("time_sk")).agg(F.count(F.lit(1)).alias("events"))
    return day.join(hits, "time_sk", "left").withColumn("events", F.coalesce("events", F.lit(0)))


DIM_TIME_SQL = """
with hits as (
    select cast(hour(ts) * 60 + minute(ts) as integer) as time_sk, count(*) as events from events group by 1
),
clock as (select cast(range as integer) as time_sk, cast(range // 60 as integer) as hour_24,
                 cast(range % 60 as integer) as minute from range(1440))
select time_sk, lpad(cast(hour_24 as varchar), 2, '0') || ':' || lpad(cast(minute as varchar), 2, '0') as full_time,
       hour_24, minute,
       case when hour_24 between 6 and 11 then 'morning' when hour_24 between 12 and 17 then 'afternoon'
            when hour_24 >= 18 then 'evening' end as time_band,
       case when hour_24 in (12, 13, 19, 20) then 'PEAK' else 'OFF_PEAK' end as peak_flag,
       coalesce(events, 0) as events
from clock left join hits using (time_sk)"""


def kept_keys(spark, sf):
    """Customers in credit hold keys from an earlier load; the others are numbered after them."""
    rows = m.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    known = in_credit(rows).select("c_custkey", (F.col("c_custkey") * 2).alias("customer_sk"))
    return stable_keys(rows.select("c_custkey"), known, "c_custkey", "customer_sk")


KEPT_KEYS_SQL = """
with top as (select coalesce(max(c_custkey * 2), 0) as base from customer where c_acctbal >= 0)
select c_custkey * 2 as customer_sk, c_custkey from customer where c_acctbal >= 0
union all
select base + row_number() over (order by c_custkey), c_custkey from customer, top where c_acctbal < 0"""


QUERIES: dict[str, tuple[m.Query, str | None]] = {
    "pii_hash": (pii_hashed, "select c_custkey, md5(c_name) as c_name, c_mktsegment from customer"),
    "pii_masks": (pii_masks, PII_MASKS_SQL),
    "content_hash": (
        text_hashes,
        """select doc_id, md5(text) as md5, sha256(text) as sha256,
           md5(regexp_replace(text, '^[^@]+', '***')) as masked_md5 from documents"""),
    "insert_if_absent": (
        insert_absent_rows,
        "select c_custkey, c_name, c_mktsegment, c_acctbal from customer where c_acctbal < 0"),
    "dim_upsert": (upsert_rows, UPSERT_SQL),
    "silver_refresh": (silver_refresh, "select c_custkey, c_name, c_mktsegment, c_acctbal from customer"),
    "silver_insert": (silver_insert, "select c_custkey, c_name, c_mktsegment, c_acctbal from customer"),
    "silver_append": (silver_append, "select o_orderkey, cast(2 as bigint) as copies from orders"),
    "load_metrics": (load_metrics, LOAD_METRICS_SQL),
    "gold_upsert": (gold_upsert, UPSERT_SQL),
    "gold_insert_ignore": (
        gold_insert_ignore,
        """select c_custkey, c_name, case when c_acctbal < 0 then c_mktsegment else 'OLD' end
           as c_mktsegment, c_acctbal from customer"""),
    "csv_scan": (csv_scan, CUSTOMERS_CHECKED_SQL),
    "json_scan": (json_scan, CUSTOMERS_CHECKED_SQL),
    "bronze_archive": (
        bronze_archive,
        """select event_id, event_type, cast(ts as date) as date, cast(hour(ts) // 6 * 6 as integer) as hour
           from events"""),
    "null_tokens": (
        null_tokens,
        """select o_orderkey, case when o_orderstatus not in ('F', 'P') then o_orderpriority end as priority,
           o_orderstatus from orders"""),
    "csv_mixed_headers": (
        mixed_headers, "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer"),
    "files_due": (files_due, "with " + FILES_SQL + " select file_path from per where kind in (2, 3, 4, 7)"),
    "file_tracking": (
        tracking_after,
        "with " + FILES_SQL + """
        select file_path, case when kind in (2, 3, 4, 7) then 'VALIDATED' else 'PENDING' end as current_stage,
               case when kind in (5, 6) then 'FAILED' else 'SUCCESS' end as status,
               kind not in (5, 6) as is_processed
        from per"""),
    "dim_customer": (dim_customer, DIM_CUSTOMER_SQL),
    "dim_driver": (dim_driver, DIM_DRIVER_SQL),
    "dim_restaurant": (dim_restaurant, DIM_RESTAURANT_SQL),
    "dim_agent": (dim_agent, DIM_AGENT_SQL),
    "dim_reason": (dim_reason, DIM_REASON_SQL),
    "dim_priority": (
        lambda s, sf: d.dim_priority(m.priorities(s, sf)),
        """select row_number() over (order by p) as priority_sk, p as priority_id,
               cast(p as varchar) as priority_code, name as priority_name,
               cast(p * 43200 as integer) as sla_first_response_min,
               cast(p * 86400 as integer) as sla_resolution_min
           from (select distinct cast(substr(o_orderpriority, 1, 1) as bigint) as p,
                        substr(o_orderpriority, 3) as name from orders)"""),
    "dim_channel": (
        lambda s, sf: d.dim_channel(m.table(s, sf, "part").select(
            F.col("p_partkey").alias("channel_id"), F.col("p_type").alias("channel_name"))),
        """select row_number() over (order by p_partkey) as channel_sk, p_partkey as channel_id,
               p_type as channel_name, cast(null as varchar) as channel_type from part"""),
    "dim_date": (dim_date, DIM_DATE_SQL),
    "dim_time": (dim_time, DIM_TIME_SQL),
    "stable_keys": (kept_keys, KEPT_KEYS_SQL),
}
