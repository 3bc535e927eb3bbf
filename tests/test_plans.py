"""Physical plans: what is read, what is shuffled, what runs outside the JVM."""

import io
import re
from contextlib import redirect_stdout

import pytest

from millrace.operators import joins
from millrace.workload import analytics, checks, loads, logs
from millrace.workload import model as m

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.mark.parametrize("query", [
    analytics.dashboard, analytics.revenue_impact, analytics.fact_timing, checks.validate_customers,
    checks.issue_report, checks.orphans, loads.pii_masks, logs.parsed, logs.event_timeline])
def test_no_python_rows_and_no_cartesian_product(spark, query):
    text = plan(query(spark, SF))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "MapInPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_dashboard_reads_only_its_columns(spark):
    text = plan(analytics.dashboard(spark, SF))
    line = [s for s in read_schemas(text) if "l_orderkey" in s]
    assert line and all("l_extendedprice" not in s and "l_tax" not in s for s in line)
    assert text.count("l_shipdate") and len(line) == 1  # events are scanned once


def test_dimensions_are_broadcast_after_the_check(spark):
    text = plan(analytics.dashboard(spark, SF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin LeftOuter (9" not in text


def test_filters_reach_the_scan(spark):
    text = plan(analytics.existing_fact(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in text


def test_row_rules_need_no_exchange(spark):
    checked = checks.validate(checks.lines(spark, SF), checks.LINES)
    assert "Exchange" not in plan(checked)


def test_one_aggregation_per_reported_file(spark):
    text = plan(checks.qr.column_issues(checks.lines(spark, SF), checks.LINES))
    assert text.count("Scan parquet") == 2  # tree line and detail line of one scan


def test_large_lookups_are_salted_not_broadcast(spark):
    lines = m.ticket_events(spark, SF)
    outlets = m.outlets(spark, SF, "agent_id")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    try:
        text = plan(joins.lookup_join(lines, outlets, "agent_id", max_rows=3))
        assert "SortMergeJoin" in text and "_salt" in text
    finally:
        spark.conf.set(conf, before)


def test_star_join_adds_one_scan_a_dimension(spark):
    """Three salted dimensions: the fact's events are read once in the plan, hot keys come from a table."""
    from millrace.workload import analytics

    base = analytics.fact(spark, SF)
    dims = [(d, k, {"city_name": n}) for d, k, n in (
        (m.customers(spark, SF), "customer_sk", "a"), (m.outlets(spark, SF, "driver_sk"), "driver_sk", "b"),
        (m.outlets(spark, SF, "restaurant_sk"), "restaurant_sk", "c"))]
    text = plan(joins.star_join(base, dims, max_rows=3))
    assert text.count("_salt") and text.count("lineitem.parquet") <= 2


@pytest.fixture
def no_broadcast(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    yield
    spark.conf.set(conf, before)


def test_fact_leaves_its_joins_placed_by_ticket(spark, no_broadcast):
    """Two exchanges for the orders, one for their tickets, one for the activity; none more to meet the timing."""
    from millrace.plans import sla

    timing = sla.ticket_timing(m.tickets(spark, SF), m.activity(spark, SF))
    text = plan(sla.with_fact(timing, analytics.fact(spark, SF)))
    assert text.count("Arguments: hashpartitioning(") == 2 + 4


def test_star_join_shuffles_no_row_for_few_values(spark, no_broadcast):
    """Each of seven values is hot: their rows of the dimension are broadcast. A null or unknown value finds nothing."""
    from pyspark.sql import functions as F

    fact = spark.range(4000).select("id", F.when(F.col("id") % 8 > 0, F.col("id") % 8).alias("k"))
    dim = spark.range(2, 1000).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    for keys in (None, fact.select("k")):
        joined = joins.star_join(fact, [(dim, "k", {"name": "n"})], max_rows=0, keys=keys)
        assert "_salt" not in plan(joined)
        got = {r.k: r.n for r in joined.select("k", "n").distinct().collect()}
        assert got == {None: None, 1: None, **{i: f"n{i}" for i in range(2, 8)}} and joined.count() == 4000
    assert "_salt" in plan(joins.star_join(fact.withColumn("k", F.col("id")), [(dim, "k", {"name": "n"})], max_rows=0))


def test_star_join_meets_the_fact_by_its_own_column(spark, no_broadcast):
    """Large dimensions are joined to the keys alone. Copies, several keys under one id, null and unknown keys stay as they are."""
    from pyspark.sql import functions as F

    from millrace.session import staged

    i = F.col("id")
    rows = spark.range(4000).select((i % 3000).alias("t"), F.when(i % 9 > 0, i % 600).alias("a"), F.when(i % 4 > 0, i % 700).alias("b"),
                                    F.when(i % 5 > 0, i % 3).alias("c"), (i % 2).alias("v"))
    fact = rows.union(rows.limit(50)).groupBy("t", "a", "b", "c", "v").agg(F.count("*").alias("n"))
    fact = staged(fact.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("copy", "n"), "fact")
    dims = [(spark.range(5, 650).select(i.alias(k), F.concat(F.lit(k), i).alias("name")), k, {"name": f"{k}_name"}) for k in "abc"]
    want = fact
    for dim, k, names in dims:
        want = want.join(dim.withColumnsRenamed(names), k, "left")
    got = joins.star_join(fact, dims, max_rows=0, keys=fact.select("t", "a", "b", "c"), by="t")
    placed = joins.star_join(fact.repartition("t"), dims, max_rows=0, keys=fact.select("t", "a", "b", "c"), by="t")
    order = sorted(want.columns)
    whole = sorted(map(tuple, want.select(*order).collect()), key=repr)
    assert len(whole) == 4050 and sorted(got.columns) == order
    assert sorted(map(tuple, got.select(*order).collect()), key=repr) == whole
    assert sorted(map(tuple, placed.select(*order).collect()), key=repr) == whole
    # one deals the fact by t, one the names
    assert len(re.findall(r"hashpartitioning\(t#", plan(placed))) == 2 and "hashpartitioning(a#" in plan(placed)


def test_running_dashboard_deals_its_rows_once(spark, no_broadcast):
    """Tickets told apart, groups summed and buckets written after one exchange; a ticket that stands twice counts once."""
    from pyspark.sql import functions as F

    from millrace.plans import dashboard, sla
    from millrace.session import staged

    i = F.col("id")
    flag = lambda c: F.when(i % 7 > 0, c)
    metrics = staged(spark.range(3000).select(
        (i % 2500).cast("string").alias("ticket_id"),
        F.when(i % 11 == 0, "UNKNOWN").otherwise(F.concat(F.lit("c"), i % 3)).alias("restaurant_city"),
        F.concat(F.lit("r"), i % 5).alias("restaurant_name"), F.lit("d").alias("driver_city"),
        flag(i % 3 == 0).alias("first_response_breached"), flag(i % 4 == 0).alias("resolution_breached"),
        (i % 6 == 0).alias("is_reopened"), flag(i % 90).alias("first_response_time"), flag(i % 900).alias("resolution_time"),
        flag((i / 4).cast("decimal(18,2)")).alias("refund_amount"), (i / 2).cast("decimal(18,2)").alias("total_revenue_impact"),
    ), "metrics")
    parts = dashboard.partials(metrics)
    assert plan(parts).count("Arguments: hashpartitioning(") == 1
    whole = sla.sla_dashboard(metrics).drop("view_refreshed_at")
    assert sorted(map(tuple, dashboard.merged(parts).collect())) == sorted(map(tuple, whole.collect()))


def test_dashboard_joins_only_the_names_it_shows(spark):
    text = plan(analytics.dashboard(spark, SF))
    assert "customer.parquet" not in text and text.count("supplier.parquet")


def test_log_tail_is_cut_by_split_first(spark, tmp_path):
    from millrace.sources.reports import read_log_text

    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(7000)))
    lines = read_log_text(spark, str(tmp_path), tail=5000)
    assert re.search(r"hashpartitioning\(_path#\d+, _split#\d+L?", plan(lines)) and lines.count() == 10_000
    assert lines.filter("value in ('a.log 1999', 'b.log 6999')").collect()[0].value == "b.log 6999"


def test_partitioned_archive_prunes(spark, tmp_path):
    from pyspark.sql import functions as F

    from millrace.sources.files import archive_raw

    ev = m.table(spark, SF, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"),
                                             (F.hour("ts") / 24).cast("int").alias("hour"))
    archive_raw(ev, str(tmp_path / "b"))
    text = plan(spark.read.parquet(str(tmp_path / "b")).filter("date = '2024-01-03'"))
    assert "PartitionFilters: [isnotnull(date" in text
