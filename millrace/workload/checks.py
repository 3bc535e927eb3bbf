"""Registered queries: contract validation, orphans, routing and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import ColumnRule, FileContract
from millrace.operators import quality_report as qr
from millrace.operators import routing
from millrace.operators.validation import (
    REASONS, RETRIES, STATUS, flag_duplicates, mark_orphans, reasons_text, valid_keys, validate,
)
from millrace.plans import kpis
from millrace.session import scratch_path
from millrace.sources.reports import read_metric_reports
from millrace.sources.standard_contracts import STANDARD
from millrace.workload import model as m
from millrace.workload.model import pct_sql

CUSTOMERS = STANDARD["customers.csv"]

LINES = FileContract("lineitem.parquet", (
    ColumnRule("l_orderkey", "integer", nullable=False),
    ColumnRule("l_linenumber", "integer", nullable=False),
    ColumnRule("l_discount", "float", minimum=0, maximum=0.1),
    ColumnRule("l_quantity", "float", minimum=2, maximum=50),
    ColumnRule("l_returnflag", "varchar", expected_values=("N", "A")),
    ColumnRule("l_shipdate", "timestamp"),
))

ORDERS = FileContract("orders.parquet", (
    ColumnRule("o_orderkey", "integer", pk=True, nullable=False),
    ColumnRule("o_custkey", "integer"),
    ColumnRule("o_totalprice", "float", minimum=5000),
    ColumnRule("o_orderstatus", "varchar", expected_values=("O", "F", "P")),
))


# ---- a delivery of customer text with every kind of defect -----------------------------------

def customers_text(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a text file would bring them, dirty by nation; customers in debt are
    delivered a second time with a later update."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    seg = F.col("c_mktsegment")
    first = m.table(spark, sf, "customer").select(
        F.when(nation == 7, F.concat(key, F.lit(".0"))).when(nation == 8, F.concat(F.lit("x"), key))
        .otherwise(key).alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.when(nation == 1, F.concat(F.lit("c"), key, F.lit("@mail"))).when(nation == 2, "")
        .otherwise(F.concat(F.lit("c"), key, F.lit("@mail.example.com"))).alias("email"),
        F.concat(F.when(nation == 6, "1").otherwise("0"), F.lpad(key, 10, "0")).alias("phone"),
        nation.cast("string").alias("region_id"),
        F.when(seg == "MACHINERY", "NaN").otherwise(F.length(seg).cast("string")).alias("segment_id"),
        F.when(nation == 3, "2024-13-01 x").when(nation == 4, "N/A").when(nation == 5, " ")
        .when(nation == 9, "invalid").otherwise("2024-01-15 10:00:00").alias("signup_date"),
        F.when(seg == "BUILDING", "male").when(seg.isin("FURNITURE", "HOUSEHOLD"), "female")
        .when(seg == "AUTOMOBILE", "unknown").alias("gender"),
        F.lit("2024-01-01 00:00:00").alias("created_at"),
        F.lit("2024-02-01 00:00:00").alias("updated_at"),
        F.col("c_acctbal").alias("balance"),
    )
    again = first.filter(F.col("balance") < 0).withColumn("updated_at", F.lit("2024-03-01 00:00:00"))
    return first.unionByName(again).drop("balance")


CUSTOMERS_TEXT_SQL = """
first_delivery as (
    select case when c_nationkey = 7 then c_custkey || '.0' when c_nationkey = 8 then 'x' || c_custkey
                else cast(c_custkey as varchar) end as customer_id,
           c_name as full_name,
           case when c_nationkey = 1 then 'c' || c_custkey || '@mail' when c_nationkey = 2 then ''
                else 'c' || c_custkey || '@mail.example.com' end as email,
           case when c_nationkey = 6 then '1' else '0' end || lpad(cast(c_custkey as varchar), 10, '0')
               as phone,
           cast(c_nationkey as varchar) as region_id,
           case when c_mktsegment = 'MACHINERY' then 'NaN'
                else cast(length(c_mktsegment) as varchar) end as segment_id,
           case when c_nationkey = 3 then '2024-13-01 x' when c_nationkey = 4 then 'N/A'
                when c_nationkey = 5 then ' ' when c_nationkey = 9 then 'invalid'
                else '2024-01-15 10:00:00' end as signup_date,
           case when c_mktsegment = 'BUILDING' then 'male'
                when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'female'
                when c_mktsegment = 'AUTOMOBILE' then 'unknown' end as gender,
           '2024-01-01 00:00:00' as created_at, '2024-02-01 00:00:00' as updated_at, c_acctbal
    from customer
),
delivery as (
    select * exclude (c_acctbal) from first_delivery
    union all
    select * exclude (c_acctbal) replace ('2024-03-01 00:00:00' as updated_at)
    from first_delivery where c_acctbal < 0
)"""

CHECKED_SQL = CUSTOMERS_TEXT_SQL + r""",
cleaned as (
    select customer_id, full_name, nullif(email, '') as email, phone, region_id,
           nullif(segment_id, 'NaN') as segment_id, nullif(trim(signup_date), '') as signup_date,
           gender, created_at, updated_at,
           case when regexp_full_match(customer_id, '-?\d+(\.0*)?')
                then cast(try_cast(customer_id as decimal(38,6)) as bigint) end as id,
           case when regexp_full_match(signup_date, '\d{4}-\d{2}-\d{2}.*')
                then try_cast(signup_date as timestamp) end as signed
    from delivery
),
checked as (
    select *, list_sort(list_filter([
        case when id is null then 'data_type:customer_id' end,
        case when signup_date is not null and signed is null then 'data_type:signup_date' end,
        case when not regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')
             then 'format:email' end,
        case when not regexp_full_match(phone, '0\d{10}') then 'format:phone' end,
        case when gender not in ('male', 'female') then 'enum:gender' end,
        case when row_number() over (partition by id order by updated_at desc, full_name desc) > 1
             then 'duplicated:customer_id' end
    ], lambda x: x is not null)) as why
    from cleaned
)"""

# keys that do not parse are all null and so copies of one another; which of them is spared
# depends on the order of all columns, so the query reports rows with a key, and the rest counted
CUSTOMERS_CHECKED_SQL = "with " + CHECKED_SQL + """
select id as customer_id, full_name, email, phone, cast(region_id as bigint) as region_id,
       cast(segment_id as bigint) as segment_id, signed as signup_date, gender,
       cast(created_at as timestamp) as created_at, cast(updated_at as timestamp) as updated_at,
       case when len(why) > 0 then 'INVALID' else 'VALID' end as record_status,
       array_to_string(why, ',') as reasons, cast(0 as integer) as retry_count
from checked"""


def checked_customers(spark, sf):
    return validate(customers_text(spark, sf), CUSTOMERS)


def validate_customers(spark, sf):
    return shown(checked_customers(spark, sf))


def shown(df: DataFrame) -> DataFrame:
    """Validation columns under plain names, reasons as text."""
    return (df.withColumn("reasons", reasons_text()).drop(REASONS)
            .withColumnsRenamed({STATUS: "record_status", RETRIES: "retry_count"}))


def validate_counts(spark, sf):
    """Rows per status and reason."""
    return (checked_customers(spark, sf).groupBy(F.col(STATUS).alias("record_status"),
                                                  reasons_text().alias("reasons"))
            .agg(F.count(F.lit(1)).alias("rows")))


VALIDATE_COUNTS_SQL = "with " + CHECKED_SQL + """
select case when len(why) > 0 then 'INVALID' else 'VALID' end as record_status,
       array_to_string(why, ',') as reasons, count(*) as rows
from checked group by all"""


# ---- typed lines ------------------------------------------------------------------------------

def lines(spark, sf):
    """Line items with line number 7 missing."""
    return m.table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"), "l_discount",
        "l_quantity", "l_returnflag", "l_shipdate")


def validate_lines(spark, sf, bounds="exclusive"):
    return (validate(lines(spark, sf), LINES, bounds=bounds)
            .groupBy(F.col(STATUS).alias("record_status"), reasons_text().alias("reasons"))
            .agg(F.count(F.lit(1)).alias("rows")))


def _lines_sql(low: str, high: str) -> str:
    return f"""
with checked as (
    select list_sort(list_filter([
        case when nullif(l_linenumber, 7) is null then 'not_allowed_nulls:l_linenumber' end,
        case when l_discount {low} 0 or l_discount {high} 0.1 then 'range:l_discount' end,
        case when l_quantity {low} 2 or l_quantity {high} 50 then 'range:l_quantity' end,
        case when l_returnflag not in ('N', 'A') then 'enum:l_returnflag' end
    ], lambda x: x is not null)) as why from lineitem
)
select case when len(why) > 0 then 'INVALID' else 'VALID' end as record_status,
       array_to_string(why, ',') as reasons, count(*) as rows from checked group by all"""


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def pk_duplicates(spark, sf):
    """Line items whose key was delivered again later; the last delivery is spared."""
    li = m.table(spark, sf, "lineitem").select(*LINE_KEY, *LINE_ORDER)
    flagged = flag_duplicates(li, LINE_KEY, [F.col(c) for c in LINE_ORDER])
    return flagged.filter("_duplicated").select(*LINE_KEY, "l_shipdate", "l_partkey")


PK_DUPLICATES_SQL = """
select l_orderkey, l_linenumber, l_shipdate, l_partkey from (
    select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc,
        l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc) as place from lineitem)
where place > 1"""


def pk_duplicates_all(spark, sf):
    """Every copy of a repeated key."""
    li = m.table(spark, sf, "lineitem").select(*LINE_KEY, "l_partkey")
    return flag_duplicates(li, LINE_KEY, [F.col("l_partkey")], "all").filter("_duplicated").drop("_duplicated")


def pk_frequency(spark, sf):
    return (m.table(spark, sf, "lineitem").groupBy(*LINE_KEY).agg(F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1"))


# ---- foreign keys -----------------------------------------------------------------------------

def checked_orders(spark, sf):
    """Orders validated, then checked against the customers in credit; the priority digit stands
    in for retries already made."""
    raw = m.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))
        .alias("o_custkey"), "o_totalprice", "o_orderstatus",
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias(RETRIES))
    parents = m.table(spark, sf, "customer").filter("c_acctbal >= 0")
    return mark_orphans(validate(raw, ORDERS), {"o_custkey": (parents, "c_custkey")})


ORDERS_SQL = """
checked_orders as (
    select o_orderkey, o_custkey, o_totalprice, o_orderstatus, retry,
           case when bad_range or copies > 1 then 'INVALID' when orphan then 'ORPHAN' else 'VALID' end
               as record_status,
           case when bad_range then 'range:o_totalprice' when orphan then 'orphan:o_custkey' else '' end
               as reasons
    from (
        select o_orderkey,
               case when o_orderpriority <> '4-NOT SPECIFIED' then o_custkey end as o_custkey,
               o_totalprice, o_orderstatus,
               cast(substr(o_orderpriority, 1, 1) as integer) - 1 as retry, o_totalprice <= 5000 as bad_range,
               count(*) over (partition by o_orderkey) as copies,
               o_orderpriority <> '4-NOT SPECIFIED' and o_custkey not in
                   (select c_custkey from customer where c_acctbal >= 0) as orphan
        from orders)
)"""


def orphans(spark, sf):
    return (shown(checked_orders(spark, sf)).filter("record_status = 'ORPHAN'")
            .select("o_orderkey", "o_custkey", "record_status", "reasons"))


def orphan_expiry(spark, sf):
    return shown(routing.expire_orphans(checked_orders(spark, sf), 3)).groupBy(
        "record_status", "reasons", "retry_count").agg(F.count(F.lit(1)).alias("rows"))


EXPIRED_SQL = ORDERS_SQL + """,
expired as (
    select *, case when record_status = 'ORPHAN' and retry >= 3 then 'INVALID' else record_status end as st,
           case when record_status = 'ORPHAN' and retry >= 3 then 'expired_orphan:o_custkey,' || reasons
                else reasons end as why from checked_orders
)"""


def _routed(spark, sf, label):
    return routing.route(checked_orders(spark, sf), "orders", "run1", 3, scratch_path(spark, label))


def route_split(spark, sf):
    """Rows per destination."""
    routed = _routed(spark, sf, "route")
    parts = [(name, getattr(routed, name)) for name in ("valid", "quarantine", "waiting")]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("key_sum")).select(
            F.lit(name).alias("destination"), "rows", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


ROUTE_SQL = "with " + EXPIRED_SQL + """
select case st when 'VALID' then 'valid' when 'INVALID' then 'quarantine' else 'waiting' end as destination,
       count(*) as rows, cast(sum(o_orderkey) as bigint) as key_sum from expired group by 1"""


def valid_rows(spark, sf):
    return _routed(spark, sf, "valid").valid


def quarantine_store(spark, sf):
    """Quarantined orders written and read back, by reason."""
    root = scratch_path(spark, "quarantine")
    routing.write_quarantine(_routed(spark, sf, "q").quarantine, root, "orders", "2024-01-01", "run1")
    stored = routing.read_quarantine(spark, root, "orders")
    return stored.groupBy(F.col(STATUS).alias("record_status"), reasons_text().alias("reasons"),
                          "table_name", F.col(routing.RUN_ID).alias("run_id")).agg(
        F.count(F.lit(1)).alias("rows"))


def orphan_waiting_room(spark, sf):
    """Orphans stored by one cycle and taken up by the next, one retry older."""
    root = scratch_path(spark, "waiting")
    routing.write_waiting(_routed(spark, sf, "w").waiting, root, "orders", 0)
    return routing.read_waiting(spark, root, "orders", 0).select(
        "o_orderkey", "o_custkey", F.col(RETRIES).alias("retry_count"))


def orphan_retry(spark, sf):
    """The waiting orders of one cycle checked again after the missing customers arrived."""
    root = scratch_path(spark, "retry")
    routing.write_waiting(_routed(spark, sf, "r").waiting, root, "orders", 0)
    again = routing.read_waiting(spark, root, "orders", 0)
    everyone = m.table(spark, sf, "customer").filter("c_acctbal >= -500")
    rechecked = mark_orphans(validate(again, ORDERS), {"o_custkey": (everyone, "c_custkey")})
    return shown(routing.expire_orphans(rechecked, 3)).groupBy("record_status", "reasons", "retry_count").agg(
        F.count(F.lit(1)).alias("rows"))


ORPHAN_RETRY_SQL = "with " + EXPIRED_SQL + """,
again as (
    select retry + 1 as retry, o_custkey in (select c_custkey from customer where c_acctbal >= -500) as found
    from expired where st = 'ORPHAN'
)
select case when found then 'VALID' when retry >= 3 then 'INVALID' else 'ORPHAN' end as record_status,
       case when found then '' when retry >= 3 then 'expired_orphan:o_custkey,orphan:o_custkey'
            else 'orphan:o_custkey' end as reasons,
       retry as retry_count, count(*) as rows from again group by all"""


# ---- quality report ---------------------------------------------------------------------------

def issue_report(spark, sf):
    """Issues per column and check over three files; the order file misses a column."""
    short = m.table(spark, sf, "orders").drop("o_orderstatus")
    return qr.report_issues([(customers_text(spark, sf), CUSTOMERS), (lines(spark, sf), LINES),
                             (short, ORDERS)])


ISSUES_SQL = CUSTOMERS_TEXT_SQL + r""",
c as (
    select * replace (nullif(email, '') as email, nullif(nullif(trim(signup_date), ''), 'N/A') as signup_date)
    from delivery
),
issues(file_name, total_rows, "column", "check", issue_type, count) as (
    select 'customers.csv', count(*), 'customer_id', 'null', 'null_value', count(*) filter (customer_id is null) from c
    union all select 'customers.csv', count(*), 'customer_id', 'type', 'schema_mismatch',
        count(*) filter (not regexp_full_match(customer_id, '-?\d+(\.0*)?')) from c
    union all select 'customers.csv', count(*), 'email', 'format', 'invalid_format',
        count(*) filter (not regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+')) from c
    union all select 'customers.csv', count(*), 'phone', 'format', 'invalid_format',
        count(*) filter (not regexp_full_match(phone, '\+?[\d\s\-().]{7,20}')) from c
    union all select 'customers.csv', count(*), 'region_id', 'type', 'schema_mismatch',
        count(*) filter (try_cast(region_id as bigint) is null and region_id is not null) from c
    union all select 'customers.csv', count(*), 'segment_id', 'type', 'schema_mismatch',
        count(*) filter (try_cast(segment_id as bigint) is null and segment_id is not null) from c
    union all select 'customers.csv', count(*), 'signup_date', 'type', 'schema_mismatch',
        count(*) filter (try_cast(signup_date as timestamp) is null and signup_date is not null) from c
    union all select 'customers.csv', count(*), 'gender', 'enum', 'invalid_format',
        count(*) filter (gender not in ('male', 'female')) from c
    union all select 'customers.csv', count(*), 'created_at', 'type', 'schema_mismatch', 0 from c
    union all select 'customers.csv', count(*), 'updated_at', 'type', 'schema_mismatch', 0 from c
    union all select 'lineitem.parquet', count(*), 'l_orderkey', 'null', 'null_value', 0 from lineitem
    union all select 'lineitem.parquet', count(*), 'l_linenumber', 'null', 'null_value',
        count(*) filter (l_linenumber = 7) from lineitem
    union all select 'lineitem.parquet', count(*), 'l_linenumber', 'type', 'schema_mismatch', 0 from lineitem
    union all select 'lineitem.parquet', count(*), 'l_discount', 'range', 'out_of_range',
        count(*) filter (l_discount < 0 or l_discount > 0.1) from lineitem
    union all select 'lineitem.parquet', count(*), 'l_quantity', 'range', 'out_of_range',
        count(*) filter (l_quantity < 2 or l_quantity > 50) from lineitem
    union all select 'lineitem.parquet', count(*), 'l_returnflag', 'enum', 'invalid_format',
        count(*) filter (l_returnflag not in ('N', 'A')) from lineitem
    union all select 'orders.parquet', count(*), 'o_orderkey', 'null', 'null_value', 0 from orders
    union all select 'orders.parquet', count(*), 'o_totalprice', 'range', 'out_of_range',
        count(*) filter (o_totalprice < 5000) from orders
    union all select 'orders.parquet', count(*), 'o_orderstatus', 'missing', 'schema_mismatch', 1 from orders
)"""


def file_metrics(spark, sf):
    return qr.per_file_metrics(issue_report(spark, sf), "run1").drop("elapsed_ms")


FILE_METRICS_SQL = "with " + ISSUES_SQL + """
select file_name, max(total_rows) as total_rows, cast(sum(count) as bigint) as issue_count,
       sum(count) = 0 as is_clean,
       cast(coalesce(sum(count) filter ("check" = 'null'), 0) as bigint) as null_issues,
       cast(coalesce(sum(count) filter ("check" = 'type'), 0) as bigint) as type_issues,
       cast(coalesce(sum(count) filter ("check" = 'enum'), 0) as bigint) as enum_issues,
       cast(coalesce(sum(count) filter ("check" = 'range'), 0) as bigint) as range_issues,
       cast(coalesce(sum(count) filter ("check" = 'format'), 0) as bigint) as format_issues,
       cast(coalesce(sum(count) filter ("check" = 'missing'), 0) as bigint) as missing_cols,
       'run1' as run_id
from issues group by file_name"""

MONTHLY_LINES = FileContract("lineitem.parquet", (
    ColumnRule("l_quantity", "float", minimum=2, maximum=50),
    ColumnRule("l_linenumber", "integer", nullable=False),
))
MONTHLY_ORDERS = FileContract("orders.parquet", (
    ColumnRule("o_totalprice", "float", minimum=3000),
    ColumnRule("o_orderkey", "integer", nullable=False),
))


def monthly_files(spark, sf):
    """One run per month, two files each."""

    def month(c):
        return F.date_format(c, "yyyy-MM").alias("run_id")

    li = m.table(spark, sf, "lineitem").select("l_quantity", F.nullif("l_linenumber", F.lit(7)).alias(
        "l_linenumber"), month("l_shipdate"))
    od = m.table(spark, sf, "orders").select("o_totalprice", "o_orderkey", month("o_orderdate"))
    issues = qr.report_issues([(li, MONTHLY_LINES), (od, MONTHLY_ORDERS)], ["run_id"])
    # latency stands in for a measured time so that it can be compared
    return qr.per_file_metrics(issues, F.col("run_id"), ("run_id", "file_name"),
                               F.lit(12.5))


MONTHLY_SQL = """
files as (
    select strftime(l_shipdate, '%Y-%m') as run_id, 'lineitem.parquet' as file_name, count(*) as total_rows,
           count(*) filter (l_linenumber = 7) as null_issues,
           count(*) filter (l_quantity < 2 or l_quantity > 50) as range_issues
    from lineitem group by 1
    union all
    select strftime(o_orderdate, '%Y-%m'), 'orders.parquet', count(*), 0,
           count(*) filter (o_totalprice < 3000) from orders group by 1
),
monthly as (
    select run_id, file_name, total_rows, null_issues + range_issues as issue_count,
           null_issues + range_issues = 0 as is_clean, null_issues, cast(0 as bigint) as type_issues,
           cast(0 as bigint) as enum_issues, range_issues, cast(0 as bigint) as format_issues,
           cast(0 as bigint) as missing_cols, cast(12.5 as double) as elapsed_ms
    from files
),
runs as (
    select run_id, count(*) as files_total, count(*) filter (is_clean) as files_clean,
           count(*) filter (not is_clean) as files_failed, cast(sum(total_rows) as bigint) as total_rows,
           cast(sum(issue_count) as bigint) as total_issues
    from monthly group by run_id
),
rated as (
    select *, cast((files_clean * 2000 + files_total) // (2 * files_total) as double) / 10 as clean_rate from runs
)"""


def run_snapshots(spark, sf):
    return qr.run_snapshot(monthly_files(spark, sf)).drop("per_file")


def run_summary(spark, sf):
    return qr.run_summary(qr.run_snapshot(monthly_files(spark, sf)).drop("per_file"))


def report_round_trip(spark, sf):
    """Monthly run reports written as JSON, scanned back, and exploded to one row per file."""
    root = scratch_path(spark, "reports")
    qr.write_report(qr.run_snapshot(monthly_files(spark, sf)), root)
    return qr.explode_runs(read_metric_reports(spark, root))


def clean_rate_trend(spark, sf):
    return qr.clean_rate_trend(run_summary(spark, sf), "run_id")


def issue_totals(spark, sf):
    return qr.issue_totals(monthly_files(spark, sf))


def worst_files(spark, sf):
    return qr.worst_files(monthly_files(spark, sf), 10).select("file_name", "issue_count")


TOTALS_SQL = "with " + MONTHLY_SQL + """
select file_name, """ + ", ".join(
    f"cast(sum({c}) as bigint) as {c}" for c in qr.MEASURES) + " from monthly group by file_name"

RATES_SQL = "with " + MONTHLY_SQL + ", t as (select " + ", ".join(
    f"sum({c}_issues) as {c}" for c in ("null", "enum", "format", "type", "range")).replace(
    "sum(null_issues) as null", "sum(null_issues) as nulls") + """, sum(total_rows) as n from monthly)
select """ + ", ".join(
    f"{pct_sql('nulls' if c == 'null' else c, 'n')} as {c}_issue_rate_pct"
    for c in ("null", "enum", "format", "type", "range")) + " from t"


QUERIES: dict[str, tuple[m.Query, str | None]] = {
    "validate_customers": (validate_customers, CUSTOMERS_CHECKED_SQL),
    "validate_counts": (validate_counts, VALIDATE_COUNTS_SQL),
    "range_exclusive": (validate_lines, _lines_sql("<=", ">=")),
    "range_inclusive": (lambda s, d: validate_lines(s, d, "inclusive"), _lines_sql("<", ">")),
    "pk_duplicates": (pk_duplicates, PK_DUPLICATES_SQL),
    "pk_duplicates_all": (
        pk_duplicates_all,
        """select l_orderkey, l_linenumber, l_partkey from lineitem
           qualify count(*) over (partition by l_orderkey, l_linenumber) > 1"""),
    "pk_frequency": (
        pk_frequency,
        """select l_orderkey, l_linenumber, count(*) as copies from lineitem
           group by 1, 2 having count(*) > 1"""),
    "orphans": (
        orphans, "with " + ORDERS_SQL + """ select o_orderkey, o_custkey, record_status, reasons
            from checked_orders where record_status = 'ORPHAN'"""),
    "orphan_expiry": (
        orphan_expiry, "with " + EXPIRED_SQL + """ select st as record_status, why as reasons,
            retry as retry_count, count(*) as rows from expired group by all"""),
    "route_split": (route_split, ROUTE_SQL),
    "route_valid": (
        valid_rows, "with " + ORDERS_SQL + """ select o_orderkey, o_custkey, o_totalprice, o_orderstatus
            from checked_orders where record_status = 'VALID'"""),
    "valid_keys": (
        lambda s, d: valid_keys(checked_orders(s, d), ORDERS),
        "with " + ORDERS_SQL + " select o_orderkey from checked_orders where record_status = 'VALID'"),
    "quarantine_store": (
        quarantine_store, "with " + EXPIRED_SQL + """ select st as record_status, why as reasons,
            'orders' as table_name, 'run1' as run_id, count(*) as rows from expired
            where st = 'INVALID' group by all"""),
    "orphan_waiting_room": (
        orphan_waiting_room, "with " + EXPIRED_SQL + """ select o_orderkey, o_custkey,
            retry + 1 as retry_count from expired where st = 'ORPHAN'"""),
    "orphan_retry": (orphan_retry, ORPHAN_RETRY_SQL),
    "issue_report": (issue_report, "with " + ISSUES_SQL + " select * from issues"),
    "file_metrics": (file_metrics, FILE_METRICS_SQL),
    "run_files": (monthly_files, "with " + MONTHLY_SQL + " select * from monthly"),
    "run_snapshots": (run_snapshots, "with " + MONTHLY_SQL + " select * from runs"),
    "run_summary": (run_summary, "with " + MONTHLY_SQL + " select * from rated"),
    "report_round_trip": (report_round_trip, "with " + MONTHLY_SQL + " select * from monthly"),
    "clean_rate_trend": (
        clean_rate_trend,
        "with " + MONTHLY_SQL + """ select run_id, clean_rate,
            round(clean_rate - 95.0, 1) as gap_to_target from rated"""),
    "issue_totals": (issue_totals, TOTALS_SQL),
    "worst_files": (
        worst_files, "with " + MONTHLY_SQL + """ select file_name, cast(sum(issue_count) as bigint)
            as issue_count from monthly group by 1 having sum(issue_count) > 0
            order by 2 desc, 1 limit 10"""),
    "kpi_records_processed": (
        lambda s, d: kpis.records_processed(qr.run_snapshot(monthly_files(s, d))),
        "with " + MONTHLY_SQL + " select cast(sum(total_rows) as bigint) as total_records_processed from runs"),
    "kpi_issue_rates": (lambda s, d: kpis.issue_rates(monthly_files(s, d)), RATES_SQL),
    "kpi_quarantine_totals": (
        lambda s, d: kpis.quarantine_totals(monthly_files(s, d)),
        "with " + MONTHLY_SQL + """ select cast(sum(issue_count) as bigint) as total_quarantined_records,
            cast(sum(missing_cols) as bigint) as total_missing_column_incidents from monthly"""),
    "kpi_file_success": (
        lambda s, d: kpis.file_success(monthly_files(s, d)),
        "with " + MONTHLY_SQL + f""" select {pct_sql('k', 'n')} as file_processing_success_rate_pct,
            cast(12.5 as double) as avg_processing_latency_ms
            from (select count(*) as n, count(*) filter (is_clean) as k from monthly)"""),
}
