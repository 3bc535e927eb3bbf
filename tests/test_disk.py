"""What a cycle leaves on disk: few copies of its rows, and no shuffle files of finished actions."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.contract import ColumnRule, FileContract
from millrace.operators import joins
from millrace.operators.loading import Lake
from millrace.operators.routing import read_quarantine
from millrace.operators.validation import (
    REASONS, RETRIES, STATUS, flag_duplicates, mark_orphans, reasons_text,
)
from millrace.session import ROW, named_rows, shared_root, shuffles_removed
from millrace.streaming import cycle

THINGS = FileContract("things.csv", (
    ColumnRule("id", "integer", pk=True, nullable=False), ColumnRule("owner", "integer"), ColumnRule("note"),
), "stream")
TEXT = "id string, owner string, note string"


def rows_in(folder):
    return sum(pq.ParquetFile(p).metadata.num_rows for p in Path(folder).rglob("*.parquet"))


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getAllFiles().mkString(" ").count("/shuffle_")


def test_a_batch_is_kept_in_bronze_and_silver_alone(spark, tmp_path):
    lake, store = Lake(spark, f"{tmp_path}/lake", "disk_lake"), f"{tmp_path}/store"
    lake.refresh("silver_owners", spark.range(50).select(F.col("id").alias("owner")))
    loader = cycle.StreamLoader(lake, THINGS, store, {"owner": ("silver_owners", "owner")})
    batch = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 40).cast("string").alias("owner"),
                                     F.lit("a").alias("note"))
    odd = spark.createDataFrame([("7", "1", "b"), ("7", "1", "b"), (None, "1", "c"), (None, "2", "d"), ("2000", "99", "e"), ("2001", None, "f")],
                                TEXT)
    work = Path(shared_root(spark).removeprefix("file://")) / "work"
    before = set(work.iterdir()) if work.exists() else set()
    loader.process(batch.unionByName(odd).repartition(5), 0)
    silver = {r.id: (r.owner, r.note) for r in lake.read("silver_things").collect()}
    assert len(silver) == lake.read("silver_things").count() == 1001 and silver[7] == (7, "a") and silver[2001] == (None, "f")
    assert ROW not in lake.read("silver_things").columns
    bad = read_quarantine(spark, f"{store}/quarantine", "things").select("id", "note", reasons_text().alias("why")).collect()
    assert sorted((r.id or 0, r.note, r.why) for r in bad) == [
        (0, "c", "duplicated:id,not_allowed_nulls:id"), (0, "d", "not_allowed_nulls:id"), (7, "b", "duplicated:id"),
        (7, "b", "duplicated:id")]
    assert [(r.id, r.owner, r[RETRIES]) for r in loader.waiting_at(0).collect()] == [(2000, 99, 1)]
    assert rows_in(f"{store}/bronze") == 1006
    assert rows_in(f"{store}/staged") == 5  # not the valid ones
    assert sum(rows_in(p) for p in set(work.iterdir()) - before) < 20  # repeated and unknown keys
    loader.process(spark.createDataFrame([("2000", "1", "late"), ("7", "3", "known")], TEXT), 1)
    assert lake.read("silver_things").filter("id = 7").first().owner == 7  # Silver's row stays
    assert {p.name.split(".")[-2] for d in (f"{store}/bronze", f"{tmp_path}/lake/silver_things") for p in Path(d).rglob("*.parquet")} == {"zstd"}


def test_rows_named_by_file_need_no_copy(spark, tmp_path):
    """Exact copies in several files, null keys and a hot key: one row of each key is spared, the last."""
    rows = [(k, v) for k in range(30) for v in range(3)] * 2 + [(None, 1), (None, 1), (None, 0)] + [(99, 5)] * 300 + [(500, 1)]
    path = f"{tmp_path}/t"
    spark.createDataFrame(rows, "k int, v int").repartition(7).write.parquet(path)
    for policy in ("keep_last", "all"):
        found = [flag_duplicates(df, ["k"], [F.col("v")], policy, row=row).groupBy("k", "v", "_duplicated").count()
                 for df, row in ((spark.read.parquet(path), None), (named_rows(spark.read.parquet(path)), ROW))]
        assert found[0].exceptAll(found[1]).isEmpty() and found[1].exceptAll(found[0]).isEmpty()
    spared = flag_duplicates(named_rows(spark.read.parquet(path)), ["k"], [F.col("v")], row=ROW).filter("not _duplicated")
    assert sorted((-1 if r.k is None else r.k, r.v) for r in spared.collect()) == sorted([(-1, 1), (99, 5), (500, 1)] + [(k, 2) for k in range(30)])


@pytest.mark.parametrize("bound", [0, 100])
def test_unknown_keys_are_found_on_keys_alone(spark, bound):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (8, "c"), (None, "d"), (9, "e")], "fk int, v string")
    members = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    lost = joins.unknown_keys(df, members, "fk", "id", bound)
    assert sorted(r.fk for r in lost.collect()) == [8, 9] and lost.schema["fk"].dataType.simpleString() == "int"
    flagged = {r.v: r.known for r in joins.flag_unless(df, lost, "fk", "known", bound).collect()}
    assert flagged == {"a": True, "b": True, "c": False, "d": False, "e": False}
    none = joins.unknown_keys(df.filter("fk = 1"), members, "fk", "id", bound)
    assert {r.known for r in joins.flag_unless(df.filter("fk = 1 or fk is null"), none, "fk", "known", bound).collect()} == {True, False}
    checked = df.withColumns({STATUS: F.when(F.col("v") == "e", "INVALID").otherwise("VALID"), REASONS: F.expr("cast(map() as map<string,array<string>>)")})
    for null_fk in ("pass", "orphan"):
        once, again = ({r.v: (r[STATUS], r[REASONS]) for r in mark_orphans(checked, {"fk": (members, "id")}, null_fk, first).collect()}
                       for first in (False, True))
        assert once == again and again["c"][0] == "ORPHAN" and again["e"][0] == "INVALID" and len(again) == 5


def silver(lake, spark, first, last):
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)
    ids = range(first, last)
    lake.append("silver_orders", spark.createDataFrame(
        [(f"o{i}", "Delivered", float(i + 1), 0.5, 1.0, float(i + 2), at(i), at(i + 40)) for i in ids if i % 7],
        "order_id string, order_status string, order_amount double, discount_amount double, delivery_fee double, "
        "total_amount double, order_created_at timestamp_ntz, delivered_at timestamp_ntz"))
    lake.append("silver_tickets", spark.createDataFrame(
        [(f"t{i}", f"o{i // 2 * 2 + 1}" if i % 5 else None, "Closed", at(i + 9), float(i), i % 3, i % 4) for i in ids],
        "ticket_id string, order_id string, status string, created_at timestamp_ntz, refund_amount double, customer_id bigint, reason_id bigint"))
    lake.append("silver_ticket_events", spark.createDataFrame(
        [(f"t{i % 3 and i}", "Open", ("InProgress", "Resolved", "Reopened", "Closed")[j], at(i + 10 * j), "n") for i in ids for j in range(i % 5)],
        "ticket_id string, old_status string, new_status string, event_ts timestamp_ntz, notes string"))


def test_a_fact_in_parts_is_the_same_fact(spark, tmp_path):
    dims = {"customer": spark.createDataFrame([(0, 70), (1, 71)], "customer_id bigint, customer_sk bigint"),
            "reason": spark.createDataFrame([(0, 90), (3, 93)], "reason_id bigint, reason_sk bigint")}
    facts = {}
    for most in (0, 1000):
        lake = Lake(spark, f"{tmp_path}/lake{most}", f"parts_lake_{most}")
        assert not cycle.update_fact(lake, "none")
        silver(lake, spark, 0, 60)
        assert cycle.update_fact(lake, "c1", dims, max_rows=most)
        silver(lake, spark, 60, 90)
        assert cycle.update_fact(lake, "c2", dims, max_rows=most) and cycle.update_fact(lake, "c3", max_rows=most)
        facts[most] = {r.ticket_id: r.asDict() for r in lake.read(cycle.FACT).collect()}
        assert lake.read(cycle.FACT).count() == 90
    assert facts[0] == facts[1000]
    assert sorted(r["ticket_sk"] for r in facts[0].values()) == list(range(1, 91))
    assert facts[0]["t0"]["total_event_count"] > 30 and {r["batch_id"] for r in facts[0].values()} == {"c1", "c2"}
    assert facts[0]["t1"]["customer_sk"] == 71 and facts[0]["t2"]["customer_sk"] is None and facts[0]["t3"]["reason_sk"] == 93


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake", "shuffle_lake")
    silver(lake, spark, 0, 60)
    keys = spark.range(1000).select((F.col("id") % 10).alias("k"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            first = keys.groupBy("k").count()
        before = shuffle_files(spark)
        assert sorted(r["count"] for r in first.collect()) == [100] * 10
        assert first.filter("k < 5").count() == 5 and len(first.collect()) == 10  # a frame may run again
    assert spark.conf.get(setting) == was
    cycle.update_fact(lake, "c1", max_rows=0)
    assert shuffle_files(spark) <= before
