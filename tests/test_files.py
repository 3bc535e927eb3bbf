"""Files judged one by one, their ledger, polling, orphans of batches, atomic tables, headers in one scan."""

import gzip
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.contract import ColumnRule, FileContract, ForeignKey
from millrace.operators.ledger import FileLedger
from millrace.operators.loading import Lake
from millrace.operators.validation import flag_duplicates
from millrace.plans import daily
from millrace.sources import arrivals, headers
from millrace.sources.files import read_csv
from millrace.streaming.cycle import CycleJob, FileLoader

ITEMS = FileContract("items.csv", (
    ColumnRule("id", "integer", pk=True, nullable=False), ColumnRule("name", "varchar"), ColumnRule("owner", "integer")), "stream")
OWNED = FileContract("items.csv", (
    ColumnRule("id", "integer", pk=True, nullable=False), ColumnRule("name", "varchar"),
    ColumnRule("owner", "integer", fk=ForeignKey("owner", "owner_id", "owners.csv"))), "batch")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return f"file:{path}"


def problems_of(problems):
    return {r.file_path.rsplit("/", 2)[-2]: (r.current_stage, r.error) for r in problems.collect()}


def test_files_are_judged_alone(spark, tmp_path):
    paths = [put(tmp_path / "a" / "items.csv", "id,name,owner\n1,x,5\n2,\"y, z\",6\n"),
             put(tmp_path / "b c+d" / "items.csv", "Owner,more,id,name\n7,m,3,w\n8,m\n"),
             put(tmp_path / "bad" / "items.csv", "id,name\n4,q\n"),
             put(tmp_path / "blank" / "items.csv", "\n \n"),
             put(tmp_path / "j" / "items.json", json.dumps([{"id": 10, "name": None, "owner": 1.0}, {"id": 11, "name": "n", "owner": 2}])),
             put(tmp_path / "one" / "items.json", '{"id": 12,\n "name": "o", "owner": NaN, "extra": {"k": [1]}}'),
             put(tmp_path / "short" / "items.json", '[{"id": 13}, {"id": 14, "name": "x"}]'),
             put(tmp_path / "torn" / "items.json", '[{"id": 1, "name": "x", "owner": 3}, {'),
             put(tmp_path / "none" / "items.json", "[]")]
    rows, bad = arrivals.read_files(spark, paths, ITEMS)
    assert problems_of(bad) == {
        "bad": ("FAILED_SCHEMA", "column_mismatch: owner"), "blank": ("FAILED_SCHEMA", "no header"),
        "short": ("FAILED_SCHEMA", "column_mismatch: owner"), "torn": ("FAILED_SCHEMA", "no records"),
        "none": ("FAILED_SCHEMA", "no records")}
    assert rows.columns == ["id", "name", "owner", "more", "_source_file", "extra"]
    got = {(r.id, r.name, r.owner, r.more, r.extra, r._source_file.rsplit("/", 2)[-2]) for r in rows.collect()}
    assert got == {("1", "x", "5", None, None, "a"), ("2", "y, z", "6", None, None, "a"), ("3", "w", "7", "m", None, "b c+d"),
                   (None, None, "8", "m", None, "b c+d"), ("10", None, "1.0", None, None, "j"), ("11", "n", "2", None, None, "j"),
                   ("12", "o", "NaN", None, '{"k":[1]}', "one")}
    kept, _ = arrivals.read_files(spark, paths, ITEMS, ["owner", "id"])
    assert kept.columns == ["owner", "id", "_source_file"] and kept.count() == 7
    nothing, bad = arrivals.read_files(spark, [paths[2]], ITEMS)
    assert nothing.count() == 0 and bad.count() == 1


def test_a_torn_archive_is_left_out(spark, tmp_path):
    good = put(tmp_path / "a" / "items.csv", "id,name,owner\n1,x,5\n")
    packed = gzip.compress(b"id,name,owner\n" + b"".join(b"%d,some name %d,7\n" % (i, i * i) for i in range(50_000)))
    torn = tmp_path / "t" / "items.csv.gz"
    torn.parent.mkdir()
    torn.write_bytes(packed[:len(packed) // 2])
    rows, bad = arrivals.archived(spark, [good, f"file:{torn}"], ITEMS, f"{tmp_path}/bronze")
    assert [r.id for r in rows.collect()] == ["1"] and problems_of(bad) == {"t": ("FAILED", "unreadable")}
    assert arrivals.archived(spark, [f"file:{torn}"], ITEMS, f"{tmp_path}/bronze2")[0] is None
    with pytest.raises(Exception, match="nowhere"):
        arrivals.archived(spark, [good], ITEMS, "nowhere://x/y")


def test_ledger(spark, tmp_path):
    ledger = FileLedger(spark, f"{tmp_path}/ledger")
    files = lambda *pairs: spark.createDataFrame(list(pairs), "file_path string, last_hash string")
    told = lambda *rows: spark.createDataFrame(list(rows), "file_path string, status string, current_stage string, record_count int, error string")
    both = files(("/in/a.csv", "h1"), ("/in/b.csv", "h2"))
    due = lambda arrived: sorted(r.file_path for r in ledger.due(arrived).collect())
    assert due(both) == ["/in/a.csv", "/in/b.csv"] and ledger.state().count() == 0
    for run in ("r1", "r2", "r3"):
        ledger.take(ledger.due(both), run)
        ledger.report(told(("/in/b.csv", "FAILED", "FAILED_SCHEMA", 0, "column_mismatch: x")), run)
        if run == "r1":
            ledger.report(told(("/in/a.csv", "SUCCESS", "VALIDATED", 7, None)), run)
            assert [r.file_path for r in ledger.failed(".*/b.*").collect()] == ["/in/b.csv"] and ledger.failed(".*/z.*").count() == 0
    assert due(both) == [] and [r.file_path for r in ledger.spent(both).collect()] == ["/in/b.csv"]
    assert due(files(("/in/a.csv", "changed"))) == ["/in/a.csv"]
    assert ledger.failed(".*").count() == 0
    state = {(r.file_path, r.pipeline_run_id): r for r in ledger.state().collect()}
    assert len(state) == 4 and state["/in/a.csv", "r1"].record_count == 7 and state["/in/b.csv", "r3"].current_stage == "FAILED_SCHEMA"
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "ledger").rglob("*.parquet")}
    ledger.take(files(("/in/c.csv", "h")), "r4")
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "ledger").rglob("*.parquet")}
    assert len(after) == len(before) + 1 and before.items() <= after.items()  # nothing is written anew
    spark.sql("create database if not exists ledger_test")
    ledger.publish("ledger_test.files")
    ledger.take(files(("/in/d.csv", "h")), "r5")
    assert spark.table("ledger_test.files").filter("file_path = '/in/d.csv' and status = 'PROCESSING'").count() == 1


def test_a_bad_file_does_not_end_the_stream(spark, tmp_path):
    """It is tried with later batches, and loaded once it has been mended."""
    loader = FileLoader(Lake(spark, f"{tmp_path}/lake", "files_lake"), ITEMS, f"{tmp_path}/store")
    run = lambda: loader.start(loader.arriving(f"{tmp_path}/in")).awaitTermination()
    put(tmp_path / "in" / "2024-01-05" / "08" / "items.csv", "id,name,owner\n1,x,5\n")
    bad = tmp_path / "in" / "2024-01-05" / "09" / "items.csv"
    put(bad, "id,name\n2,y\n")
    run()
    ids = lambda: sorted(r.id for r in loader.lake.read(loader.table).collect())
    assert ids() == [1]
    put(bad, "owner,name,id\n6,y,2\n")
    put(tmp_path / "in" / "2024-01-05" / "10" / "items.csv", "name,id,owner\nz,3,7\n")
    run()
    assert ids() == [1, 2, 3]
    assert {r.current_stage for r in loader.ledger.state().collect()} == {"VALIDATED", "FAILED_SCHEMA"}
    # another checkpoint delivers everything again
    loader.load_files([(r.file_path, r.last_hash) for r in loader.ledger.state().filter("status = 'SUCCESS'").collect()], "again", 9)
    assert ids() == [1, 2, 3] and loader.ledger.state().filter("pipeline_run_id = 'items-again'").count() == 0


def test_polling_does_the_whole_cycle(spark, tmp_path):
    """A parent that comes late is found by a tick, a file that comes late by the source; no step is called by hand."""
    lake = Lake(spark, f"{tmp_path}/lake", "polling_lake")
    loader = FileLoader(lake, ITEMS, f"{tmp_path}/store", {"owner": ("silver_owners", "owner_id")}, max_retries=10_000)
    put(tmp_path / "in" / "2024-01-05" / "08" / "items.csv", "id,name,owner\n1,x,5\n2,y,6\n")
    query = CycleJob(lake, [loader], f"{tmp_path}/store").start(f"{tmp_path}/in", "1 second")

    def until(ids):
        ends = time.monotonic() + 120
        while time.monotonic() < ends and query.isActive:
            if lake.exists("silver_items") and sorted(r.id for r in lake.read("silver_items").collect()) == ids:
                return True
            time.sleep(0.3)
        return False

    try:
        assert until([])
        lake.refresh("silver_owners", spark.createDataFrame([(5,)], "owner_id bigint"))
        assert until([1])
        put(tmp_path / "in" / "2024-01-05" / "09" / "items.csv", "id,name,owner\n3,z,5\n")
        assert until([1, 3])
        assert query.exception() is None
    finally:
        query.stop()
    waiting = loader.waiting_at(loader.last_cycle())
    assert [r.id for r in waiting.collect()] == [2]


def test_batch_orphans_come_back_and_bad_files_take_nothing(spark, tmp_path):
    lake, folder = Lake(spark, f"{tmp_path}/lake", "batch_lake"), tmp_path / "in"
    put(folder / "a" / "items.csv", "id,name,owner\n1,x,5\n2,y,6\n")
    put(folder / "b" / "items.csv", "id,name,owner\n3,z,5\n")
    lake.refresh("silver_owners", spark.createDataFrame([(5,)], "owner_id bigint"))
    load = lambda run, **more: {o.path.rsplit("/", 2)[-2] if o.path else "": o.stage for o in daily.load_batch_folder(
        lake, str(folder), [OWNED], f"{tmp_path}/s", run, "2024-01-05", **more)}
    ids = lambda: sorted((r.id, r.name) for r in lake.read("silver_items").collect())
    assert load("r1") == {"a": "VALIDATED", "b": "VALIDATED"} and ids() == [(1, "x"), (3, "z")]
    lake.refresh("silver_owners", spark.createDataFrame([(5,), (6,)], "owner_id bigint"))
    assert load("r2") == {"": "SKIPPED"} and ids() == [(1, "x"), (2, "y"), (3, "z")]
    # b comes back without a column: it fails, its earlier rows stay; a brings a new row
    put(folder / "a" / "items.csv", "id,name,owner\n1,new,5\n2,y,6\n4,w,77\n")
    put(folder / "b" / "items.csv", "id,name\n3,gone\n")
    for run, stage in (("r3", "FAILED_SCHEMA"), ("r4", "FAILED_SCHEMA"), ("r5", "SPENT")):
        assert load(run)["b"] == stage
        assert ids() == [(1, "new"), (2, "y"), (3, "z")]
    put(folder / "a" / "items.csv", "id,name,owner\n1,newer,5\n")
    assert load("r6") == {"a": "VALIDATED", "b": "SPENT"}
    assert ids() == [(1, "newer"), (3, "z")]
    room = daily.batch_room(lake, f"{tmp_path}/s", OWNED)
    assert [r.id for r in room.left_by(room.last()).collect()] == [4]
    lake.refresh("silver_owners", spark.createDataFrame([(5,), (6,), (77,)], "owner_id bigint"))
    put(folder / "a" / "items.csv", "id,name,owner\n1,newest,5\n")
    assert load("r7", max_attempts=9) == {"a": "VALIDATED", "b": "FAILED_SCHEMA"}
    assert ids() == [(1, "newest"), (3, "z"), (4, "w")]


def test_readers_go_on_while_a_table_is_replaced(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake", "atomic_lake")
    make = lambda n: spark.range(1000).select("id", F.lit(n).alias("version"))
    lake.refresh("t", make(0))
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append([tuple(r) for r in lake.read("t").groupBy("version").count().collect()])
            except Exception as exc:  # any failure of a reader is what the test looks for
                failures.append(exc)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for n in range(1, 9):
        lake.refresh("t", make(n))
    done.set()
    for r in readers:
        r.join()
    assert not failures and all(len(s) == 1 and s[0][1] == 1000 for s in seen) and len(seen) > 8
    lake.refresh("t", make(9).withColumn("more", F.lit("x")))  # other columns
    assert lake.read("t").columns == ["id", "version", "more"] and lake.read("t").first().version == 9


def test_headers_take_a_fixed_number_of_jobs(spark, tmp_path):
    def jobs(count):
        folder = tmp_path / f"n{count}"
        for i in range(count):
            put(folder / f"{i:05}.csv", f"a,b\n{i},x\n" if i % 3 else f"b,c,a\nx,y,{i}\n")
        spark.sparkContext.setJobGroup(f"headers-{count}", "count")
        df = read_csv(spark, str(folder))
        assert df.columns == ["b", "c", "a"]
        rows = df.collect()
        assert sorted(int(r.a) for r in rows) == list(range(count)) and {r.b for r in rows} == {"x"}
        assert all((r.c == "y") == (int(r.a) % 3 == 0) for r in rows)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{count}"))

    jobs(40)
    assert jobs(400) == jobs(80)
    assert headers.read_by_header(spark, put(tmp_path / "e" / "x.csv", "")).columns == []


def test_duplicates_scan_their_source_once(spark, tmp_path):
    spark.range(500).select((F.col("id") % 400).alias("k"), "id").write.parquet(f"{tmp_path}/t")
    counted = spark.sparkContext.accumulator(0)
    rows = spark.read.parquet(f"{tmp_path}/t").mapInArrow(lambda bs: (counted.add(b.num_rows) or b for b in bs), "k bigint, id bigint")
    flagged = flag_duplicates(rows, ["k"], [F.col("id")])
    assert flagged.filter("_duplicated").count() == 100 and counted.value == 500
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # no row of a unique key is shuffled


def test_keys_without_copies_are_only_counted(spark):
    rows = spark.range(500).select("id", F.repeat(F.lit("x"), 1000).alias("wide"))
    flagged = flag_duplicates(rows, ["id"], [F.col("wide")])
    assert flagged.filter("not _duplicated").count() == 500
    assert "Join" not in flagged._jdf.queryExecution().executedPlan().toString()


def test_repeats_take_a_batch_a_delivery(spark, tmp_path, monkeypatch):
    """Batches do not become more with the files of a delivery."""
    from millrace.streaming.cycle import StreamLoader
    from millrace.workload import streams

    spark.range(30).select(F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus")
                           ).repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    batches, process = [], StreamLoader.process
    monkeypatch.setattr(StreamLoader, "process", lambda self, batch, n: batches.append(n) or process(self, batch, n))
    assert streams.stream_repeats(spark, str(tmp_path)).collect() == [(90, 30, 30)]
    assert len(batches) <= 4  # the last one has no rows, it clears the state


def test_a_batch_is_read_once(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake", "once_lake")
    lake.refresh("t", spark.range(50).select("id", F.lit("old").alias("v")))
    counted = spark.sparkContext.accumulator(0)
    batch = spark.range(100).mapInArrow(lambda bs: (counted.add(b.num_rows) or b for b in bs), "id bigint").select("id", F.lit("new").alias("v"))
    done = lake.insert_absent("t", batch.union(batch.limit(0)), ["id"])
    assert (done.attempted, done.inserted, done.skipped, counted.value) == (100, 50, 50, 100)
    assert lake.read("t").filter("v = 'new'").count() == 50


def test_an_upsert_rewrites_few_files(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake", "bucket_lake", bucket_rows=16)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "id bigint, v string")
    lake.upsert("dim", rows(range(1000), "old"), ["id"])
    files = lambda: {p for p in (tmp_path / "lake" / "dim").rglob("*.parquet") if "_bucket=" in str(p)}
    before = files()
    lake.upsert("dim", rows([*range(0, 1000, 100), 2000], "new"), ["id"])
    written = files() - before
    assert {int(str(p).split("_bucket=")[1].split("/")[0]) for p in written} == {
        r[0] for r in lake.bucketed("dim").placed(rows([*range(0, 1000, 100), 2000], "x")).select("_bucket").distinct().collect()}
    assert len(written) <= 11 < 0.25 * len(before) and before <= files()
    got = {r.id: r.v for r in lake.read("dim").collect()}
    assert got == {**{i: "old" for i in range(1000)}, **{i: "new" for i in range(0, 1000, 100)}, 2000: "new"}
    assert lake.insert_ignore("dim", rows([5, 3000], "ignored"), ["id"]).inserted == 1
    assert {r.v for r in lake.read("dim").filter("id in (5, 3000)").collect()} == {"old", "ignored"}
    lake.upsert("dim", rows([3000, 3000], "again"), ["id"])
    assert lake.read("dim").filter("id = 3000").collect() == [(3000, "again")] and lake.read("dim").count() == 1002
    lake.refresh("dim", rows([1], "whole"))
    assert lake.read("dim").collect() == [(1, "whole")]
    lake.upsert("dim", rows([1, 2], "back"), ["id"])  # a plain table is rewritten in buckets once
    assert lake.bucketed("dim").exists() and sorted(lake.read("dim").collect()) == [(1, "back"), (2, "back")]
    lake.upsert("empty", rows([], "x"), ["id"])
    assert lake.read("empty").count() == 0
