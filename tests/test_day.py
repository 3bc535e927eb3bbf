"""A whole day on the fixture tree: batch files, dimensions, streams, fact, views, replays."""

import shutil
from decimal import Decimal

import fixture_tree as tree
import pytest

from millrace.functions.masking import pii_hash
from millrace.operators.loading import Lake
from millrace.operators.routing import read_quarantine
from millrace.plans import daily, sla
from millrace.sources.files import stream_source
from millrace.sources.standard_contracts import STANDARD, TICKET_EXTRAS
from millrace.streaming import cycle

PARENTS = {
    "orders": {"customer_id": ("silver_customers", "customer_id"),
               "restaurant_id": ("silver_restaurants", "restaurant_id"),
               "driver_id": ("silver_drivers", "driver_id")},
    "tickets": {"order_id": ("silver_orders", "order_id"), "reason_id": ("silver_reasons", "reason_id")},
    "ticket_events": {},
}


def loaders(spark, lake, root, store, max_files=None):
    pairs = []
    for contract in STANDARD.section("stream"):
        extras = TICKET_EXTRAS if contract.stem == "tickets" else {}
        source = stream_source(spark, f"{root}/stream", contract, extra=extras, max_files=max_files)
        pairs.append((cycle.StreamLoader(lake, contract, store, PARENTS[contract.stem], extras), source))
    return pairs


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("day"))
    tree.master(f"{root}/master")
    tree.batch(f"{root}/batch")
    tree.stream(f"{root}/stream")
    lake = Lake(spark, f"{root}/lake", "day_lake")

    def streams(dims):
        return cycle.run_cycle(loaders(spark, lake, root, f"{root}/store"), lake, "c1", dims)

    ok = daily.run_day(lake, [f"{root}/master", f"{root}/batch"], STANDARD, f"{root}/store", "run1",
                       "2024-01-05", streams)
    assert ok
    return root, lake


def test_batch_tables(spark, day):
    root, lake = day
    people = {r.customer_id: r for r in lake.read("silver_customers").collect()}
    assert set(people) == {1, 2}  # bad phone, unknown region and the older copy are out
    digest = spark.createDataFrame([("Person 1",)], "v string").select(pii_hash(
        __import__("pyspark.sql.functions", fromlist=["col"]).col("v"))).first()[0]
    assert people[1].full_name == digest
    bad = read_quarantine(spark, f"{root}/store/quarantine", "customers")
    assert bad.count() == 2
    waiting = spark.read.parquet(f"{root}/store/orphans_batch/table_name=customers")
    assert [r.customer_id for r in waiting.collect()] == [8]
    assert lake.read("silver_regions").count() == 2


def test_tracking(day):
    _, lake = day
    done = lake.read("file_tracking")
    assert done.filter("status = 'SUCCESS'").count() == 13 and done.filter("status <> 'SUCCESS'").count() == 0


def test_dimensions(day):
    _, lake = day
    dims = daily.dimensions(lake)
    one = dims["customer"].filter("customer_id = 1").first()
    assert (one.city_name, one.region_name, one.segment_name) == ("Cairo", "Maadi", "Gold")
    assert one.delivery_base_fee == Decimal("10.50") and one.segment_discount_pct == 5
    assert dims["restaurant"].first().category_name == "Grill" and dims["agent"].first().team_name == "North"


def test_streams_and_fact(spark, day):
    root, lake = day
    assert {r.order_id for r in lake.read("silver_orders").collect()} == {"o1", "o2", "o3", "o6"}
    facts = {r.ticket_id: r for r in lake.read("fact_ticket_lifecycle").collect()}
    assert set(facts) == {"t1", "t2", "t3"} and sorted(f.ticket_sk for f in facts.values()) == [1, 2, 3]
    t1, t2, t3 = facts["t1"], facts["t2"], facts["t3"]
    assert (t1.first_response_time_min, t1.resolution_time_min) == (1, 20)
    assert t1.sla_first_response_breached is False and t1.sla_resolution_breached is True
    assert (t1.total_event_count, t1.reopen_count, t1.is_reopened) == (4, 2, True)
    assert t1.refund_impact_pct == Decimal("20.00") and t1.customer_sk is not None
    assert (t1.resolved_date_sk, t1.resolved_time_sk) == (20240105, 9 * 60 + 20)
    assert t1.order_total_time_min == 40 and t1.order_to_ticket_time_min == 60
    assert t2.resolution_time_min is None and t2.sla_resolution_breached is None and t2.closed_time_sk == 570
    assert t3.refund_impact_pct is None  # 4200 percent does not fit
    assert (t3.total_event_count, t3.first_response_time_min) == (0, None)
    assert lake.read("silver_ticket_events").filter("notes = 'Agent responded'").count() == 0  # hashed


def test_views(spark, day):
    _, lake = day
    dims = daily.dimensions(lake)
    names = cycle.refresh_views(lake, dims)
    assert cycle.empty_views(spark, [*names, "view_nope"]) == ["view_nope"]
    per = {r.ticket_id: r for r in spark.table("view_sla_metrics").collect()}
    assert per["t1"].is_reopened and per["t1"].restaurant_city == "Cairo" and per["t1"].driver_city == "Giza"
    board = spark.table("view_sla_dashboard").collect()
    assert len(board) == 1 and board[0].total_tickets == 3
    assert board[0].sla_breach_rate_pct == 66.67  # t1 resolution, t2 response
    impact = spark.table("view_revenue_impact").first()
    assert impact.impacted_tickets == 3 and impact.total_revenue_impact == Decimal("63.00")
    cycle.materialize_dashboard(lake, spark.table("view_sla_dashboard"))
    assert "materialized_at" in lake.read("mv_sla_dashboard_daily").columns
    alerts = sla.breach_alerts(spark.table("view_sla_dashboard"))
    assert [r.alert_level for r in alerts.collect()] == ["CRITICAL"]


def test_everything_again_changes_nothing(spark, day):
    root, lake = day
    tables = ["silver_orders", "silver_tickets", "silver_ticket_events", "fact_ticket_lifecycle", "dim_customer"]
    before = {t: lake.read(t).count() for t in tables}
    keys = {r.customer_id: r.customer_sk for r in lake.read("dim_customer").collect()}
    outcomes = daily.load_batch_folder(lake, f"{root}/master", STANDARD.section("master"), f"{root}/store",
                                       "run2", "2024-01-06")
    assert {o.stage for o in outcomes} == {"SKIPPED"}
    dims = daily.build_dimensions(lake)
    # new checkpoints: every file is delivered a second time
    assert cycle.run_cycle(loaders(spark, lake, root, f"{root}/store2"), lake, "c2", dims)
    assert {t: lake.read(t).count() for t in tables} == before
    assert {r.customer_id: r.customer_sk for r in lake.read("dim_customer").collect()} == keys


def test_late_customer_then_expiry(spark, day):
    """o4 waits for customer 99; t9 waits for an order that never comes and expires."""
    root, lake = day
    store = f"{root}/store"
    order_loader, ticket_loader = [p[0] for p in loaders(spark, lake, root, store)[:2]]
    batches = order_loader.waiting_at(0)
    assert [r.order_id for r in batches.collect()] == ["o4"]
    late = lake.read("silver_customers").limit(1).replace(1, 99, ["customer_id"]).replace(2, 99, ["customer_id"])
    lake.append("silver_customers", late)
    nothing = spark.createDataFrame([], STANDARD["orders.json"].read_schema())
    order_loader.process(nothing, 1)
    order_loader.process(nothing, 1)  # replayed batch
    assert lake.read("silver_orders").filter("order_id = 'o4'").count() == 1
    assert order_loader.waiting_at(1).count() == 0
    empty = spark.createDataFrame([], STANDARD["tickets.csv"].read_schema(list(TICKET_EXTRAS)))
    for step in (1, 2, 3):
        assert ticket_loader.waiting_at(step - 1).count() == 1
        ticket_loader.process(empty, step)
    assert ticket_loader.waiting_at(3).count() == 0
    bad = read_quarantine(spark, f"{store}/quarantine", "tickets").filter("ticket_id = 't9'").collect()
    assert len(bad) == 1 and "expired_orphan" in bad[0]._error_reasons and bad[0]._retry_count == 3


def test_one_file_at_a_time_gives_same_tables(spark, day, tmp_path):
    root, lake = day
    other = Lake(spark, f"{tmp_path}/lake", "day_lake_small")
    for name in ("silver_customers", "silver_restaurants", "silver_drivers", "silver_reasons"):
        other.refresh(name, lake.read(name).filter("customer_id < 99") if name == "silver_customers"
                      else lake.read(name))
    assert cycle.run_cycle(loaders(spark, other, root, f"{tmp_path}/store", max_files=1), other, "c1")
    def key(name, col):
        return {r[0] for r in other.read(name).select(col).collect()}
    assert key("silver_orders", "order_id") == {"o1", "o2", "o3", "o6"}
    assert key("silver_tickets", "ticket_id") == {"t1", "t2", "t3"}
    assert key("fact_ticket_lifecycle", "ticket_id") == {"t1", "t2", "t3"}


def test_failures_are_reported(spark, day, tmp_path):
    root, _ = day
    lake = Lake(spark, f"{tmp_path}/lake", "day_lake_bad")
    folder = f"{tmp_path}/batch"
    shutil.copytree(f"{root}/master", folder)
    tree.write_csv(f"{folder}/teams.csv", [dict(team_id=1)])  # column missing
    outcomes = daily.load_batch_folder(lake, folder, STANDARD.section("master"), f"{tmp_path}/s", "r", "2024-01-05")
    state = {o.file_name: o.stage for o in outcomes}
    assert state["teams.csv"] == "FAILED_SCHEMA" and state["cities.json"] == "VALIDATED"
    assert not daily.run_day(lake, [folder], STANDARD, f"{tmp_path}/s", "r2", "2024-01-05")
    tracked = {r.file_path.rsplit("/", 1)[-1]: r.current_stage
               for r in lake.read("file_tracking").filter("pipeline_run_id = 'r'").collect()}
    assert tracked["teams.csv"] == "FAILED_SCHEMA"
    assert not cycle.update_fact(lake, "x")  # Silver tables missing


def test_all_files_of_a_contract_are_loaded(spark, day, tmp_path):
    """Two files of one stem are one table; a bad one fails alone; spent and absent files are failures."""
    lake = Lake(spark, f"{tmp_path}/lake", "day_lake_many")
    folder = tmp_path / "in"
    for part, rows in (("a", [dict(category_id=1, category_name="Grill")]), ("b", [dict(category_id=2, category_name="Fish")])):
        (folder / part).mkdir(parents=True)
        tree.write_csv(f"{folder}/{part}/categories.csv", rows)
    contracts = [c for c in STANDARD.section("batch") if c.stem in ("categories", "teams")]

    def load(run, **more):
        return daily.load_batch_folder(lake, str(folder), contracts, f"{tmp_path}/s", run, "2024-01-05", **more)

    first = load("r1")
    assert [o.stage for o in first if o.file_name.startswith("categories")] == ["VALIDATED"] * 2
    assert {r.category_name for r in lake.read("silver_categories").collect()} == {"Grill", "Fish"}
    assert [o.stage for o in first if o.file_name.startswith("teams")] == ["ABSENT"] and all(o.ok for o in first)
    assert {o.stage for o in load("r2")} == {"SKIPPED", "ABSENT"}
    assert not all(o.ok for o in load("r3", required=["teams"]))
    tree.write_csv(f"{folder}/b/teams.csv", [dict(team_id=1)])
    for run in ("r4", "r5", "r6"):
        assert [o.stage for o in load(run) if o.file_name.startswith("teams")] == ["FAILED_SCHEMA"]
    spent = [o for o in load("r7") if o.file_name.startswith("teams")]
    assert [o.stage for o in spent] == ["SPENT"] and not spent[0].ok
    assert not daily.run_day(lake, [str(folder)], STANDARD, f"{tmp_path}/s", "r8", "2024-01-05", required=["drivers"])


def test_without_the_parent_table_keys_wait(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake", "day_lake_orphans")
    folder = tmp_path / "in"
    folder.mkdir()
    tree.write_csv(f"{folder}/regions.csv", [dict(region_id=1, region_name="R", city_id=77, delivery_base_fee="1.0")])
    contracts = [c for c in STANDARD.section("batch") if c.stem == "regions"]
    daily.load_batch_folder(lake, str(folder), contracts, f"{tmp_path}/s", "r", "2024-01-05")
    assert lake.read("silver_regions").count() == 0
    assert spark.read.parquet(f"{tmp_path}/s/orphans_batch/table_name=regions").count() == 1


def test_waiting_rows_are_tried_without_new_files(spark, day, tmp_path):
    root, lake = day
    other = Lake(spark, f"{tmp_path}/lake", "day_lake_retry")
    other.refresh("silver_restaurants", lake.read("silver_restaurants"))
    other.refresh("silver_drivers", lake.read("silver_drivers"))
    pair = loaders(spark, other, root, f"{tmp_path}/store")[0]  # customers are not there yet
    cycle.run_cycle([pair], other, "c1")
    loader = pair[0]
    assert loader.waiting_at(loader.last_cycle()).count() > 0 and not other.read("silver_orders").count()
    other.refresh("silver_customers", lake.read("silver_customers"))
    cycle.run_cycle([pair], other, "c2")
    assert {r.order_id for r in other.read("silver_orders").collect()} >= {"o1", "o2", "o3"}
    assert loader.last_cycle() == 0
