import gzip
import hashlib
import json

import fixture_tree as tree
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import rules
from millrace.operators import quality_report as qr
from millrace.operators.validation import STATUS, validate
from millrace.plans import daily, logs
from millrace.sources import files, reports
from millrace.sources.standard_contracts import STANDARD


@pytest.fixture
def root(tmp_path):
    tree.master(f"{tmp_path}/master")
    tree.batch(f"{tmp_path}/batch")
    tree.stream(f"{tmp_path}/stream")
    return str(tmp_path)


def test_csv_keeps_text(spark, root):
    df = files.read_source(spark, f"{root}/batch/customers.csv", STANDARD["customers.csv"])
    assert set(dict(df.dtypes).values()) == {"string"}
    assert df.filter("customer_id = '2'").first().phone == "01012345672"


def test_json_array_with_nan_and_mixed_types(spark, tmp_path):
    path = f"{tmp_path}/orders.json"
    with open(path, "w") as f:
        f.write('[{"order_id": "a", "customer_id": NaN, "order_amount": 3, "extra": true},'
                ' {"order_id": 7, "customer_id": 12.0, "order_amount": "x"}]')
    df = files.read_source(spark, path, STANDARD["orders.json"])
    got = {r.order_id: r for r in df.collect()}
    assert got["a"].customer_id is None and got["a"].extra == "true" and got["a"].order_amount == "3"
    assert got["7"].customer_id == "12.0" and got["7"].order_amount == "x"


def test_json_lines_object_and_array(spark, tmp_path):
    for name, text, array in (("one", '{"city_id": 1}', True), ("many", '[{"city_id": 1},{"city_id": 2}]', True),
                              ("nd", '{"city_id": 1}\n{"city_id": 2}\n{"city_id": 3}\n', False)):
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        df = files.read_source(spark, str(path), STANDARD["cities.json"], array=array,
                               schema=STANDARD["cities.json"].read_schema())
        assert df.count() == {"one": 1, "many": 2, "nd": 3}[name]


def test_guarded_scans_are_empty(spark, tmp_path):
    c = STANDARD["teams.csv"]
    (tmp_path / "teams.csv").write_text("")
    (tmp_path / "teams.xml").write_text("<a/>")
    for path in (f"{tmp_path}/absent.csv", f"{tmp_path}/teams.csv", f"{tmp_path}/teams.xml", f"{tmp_path}/x.json"):
        df = files.read_source(spark, path, c)
        assert df.columns == c.names and df.count() == 0


def test_null_tokens(spark, tmp_path):
    (tmp_path / "teams.csv").write_text('team_id,team_name\n1,N/A\n2,"NULL"\n3, None \n4,Nope\n')
    df = files.read_source(spark, f"{tmp_path}/teams.csv", STANDARD["teams.csv"], tokens=rules.NULL_TOKENS)
    assert [r.team_name for r in df.orderBy("team_id").collect()] == [None, None, None, "Nope"]


def test_stream_folders(spark, root):
    hour = files.read_stream_hour(spark, f"{root}/stream", STANDARD, "2024-01-05", 8)
    assert set(hour) == {"orders", "tickets", "ticket_events"} and hour["orders"].count() == 5
    row = hour["tickets"].first()
    assert (row.date, row.hour) == ("2024-01-05", 8) and row._source_file.endswith("/08/tickets.csv")
    every = files.read_stream_all(spark, f"{root}/stream", STANDARD)
    assert every["orders"].count() == 7 and files.read_stream_hour(spark, root, STANDARD, "2020-01-01") == {}


def test_all_sources(spark, root):
    found = files.read_all_sources(spark, root, STANDARD, "2024-01-05")
    assert set(found) == {"stream", "batch", "master"}
    assert set(found["master"]) == {"cities", "regions", "categories", "segments", "teams", "reason_categories"}
    assert len(found["batch"]) == 7
    only = files.read_all_sources(spark, root, STANDARD, "2024-01-05", 9, include_batch=False)
    assert set(only) == {"stream"} and only["stream"]["orders"].count() == 2


def test_hash_and_allow_list(spark, root, tmp_path):
    (tmp_path / "batch" / "notes.csv").write_text("x\n1\n")
    (tmp_path / "batch" / "teams.csv").write_text("")
    df = files.hash_files(spark, f"{root}/batch")
    one = df.filter(F.col("file_path").endswith("customers.csv")).first()
    assert one.last_hash == hashlib.sha256((tmp_path / "batch/customers.csv").read_bytes()).hexdigest()
    names = {r.file_path.rsplit("/", 1)[-1] for r in files.known_files(df, STANDARD).collect()}
    assert "notes.csv" not in names and "teams.csv" not in names and "restaurants.json" in names


def test_archive_replaces_only_its_hours(spark, root, tmp_path):
    out = f"{tmp_path}/bronze"
    everything = files.read_stream_all(spark, f"{root}/stream", STANDARD)["orders"]
    files.archive_raw(everything, out)
    files.archive_raw(everything.filter("hour = 9"), out, "overwrite")
    stored = spark.read.parquet(out)
    assert stored.count() == 7 and {"_source_file", "_ingested_at"} <= set(stored.columns)


LINE = "2026-04-10T08:00:{:02d}  {}  [job]  message {}\n"


def test_logs(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.log").write_text("".join(LINE.format(i, "INFO", i) for i in range(30)) + "junk\n")
    (tmp_path / "y.log").write_text(LINE.format(59, "ERROR", "last"))
    (tmp_path / "z.txt").write_text(LINE.format(1, "ERROR", "no"))
    df = reports.read_logs(spark, str(tmp_path))
    assert df.count() == 31 and df.first().message == "message last"
    tail = reports.read_logs(spark, str(tmp_path), tail=5)
    assert sorted(r.message for r in tail.collect()) == sorted(
        ["message last", *[f"message {i}" for i in range(26, 30)]])
    assert {r.source_file for r in df.collect()} == {"x.log", "y.log"}
    page = logs.filter_logs(df, "info", logger="JOB", message="Message 1", last_n=3)
    assert [r.message for r in page.collect()] == ["message 19", "message 18", "message 17"]
    assert [tuple(r) for r in logs.count_by_level(df).collect()] == [("ERROR", 1), ("INFO", 30)]
    logs.export_csv(page, f"{tmp_path}/out")
    assert "level_rank" not in spark.read.option("header", True).csv(f"{tmp_path}/out").columns
    assert reports.read_logs(spark, str(tmp_path / "a")).filter("level = 'ERROR'").count() == 0


def test_timeline_fills_quiet_minutes(spark):
    ts = ["2024-01-01 23:58:10", "2024-01-01 23:58:50", "2024-01-02 00:01:00", None]
    df = spark.createDataFrame([(t,) for t in ts], "t string").select(F.col("t").cast("timestamp_ntz").alias("timestamp"))
    got = [(str(r.minute), r["count"]) for r in logs.timeline(df).orderBy("minute").collect()]
    assert got == [("2024-01-01 23:58:00", 2), ("2024-01-01 23:59:00", 0), ("2024-01-02 00:00:00", 0),
                   ("2024-01-02 00:01:00", 1)]


def test_json_line_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"timestamp": "2024-01-01T00:00:01", "a": 1}\nbroken\n{"b": "x"}\n')
    df = reports.read_json_lines(spark, str(tmp_path))
    assert df.count() == 2 and set(df.columns) >= {"a", "b", "timestamp"}
    assert dict(df.dtypes)["timestamp"] == "timestamp"


def test_quality_run_report(spark, root, tmp_path):
    sources = files.read_all_sources(spark, root, STANDARD, "2024-01-05")
    report = daily.quality_run(sources, STANDARD, "run9", f"{tmp_path}/reports")
    row = report.first()
    assert row.files_total == 16 and row.files_failed >= 2
    back = reports.read_metric_reports(spark, f"{tmp_path}/reports")
    assert back.first().run_id == "run9" and back.first().recorded_at is not None
    per_file = qr.explode_runs(back)
    orders = per_file.filter("file_name = 'orders.json'").first()
    assert orders.range_issues == 1 and orders.total_rows == 7 and orders.elapsed_ms > 0
    customers = per_file.filter("file_name = 'customers.csv'").first()
    assert customers.format_issues == 1  # report pattern for phones is the looser one
    summary = qr.run_summary(back)
    assert summary.first().clean_rate == round(row.files_clean / row.files_total * 100, 1)
    assert qr.clean_rate_trend(summary).first().gap_to_target == round(summary.first().clean_rate - 95, 1)
    worst = qr.worst_files(per_file, 1).collect()
    assert len(worst) == 1 and worst[0].issue_count > 0


def test_report_defaults(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"recorded_at": "2024-01-01T00:00:00", "files_clean": 1}))
    row = reports.read_metric_reports(spark, str(tmp_path)).first()
    assert (row.run_id, row.files_total, row.total_rows) == ("?", 0, 0)


def test_empty_report_run(spark):
    with pytest.raises(ValueError):
        daily.quality_run({}, STANDARD, "r", "/tmp/never")


def test_gzip_csv(spark, tmp_path):
    with gzip.open(f"{tmp_path}/teams.csv.gz", "wt") as f:
        f.write("team_id,team_name\n1,x\n")
    df = files.read_source(spark, f"{tmp_path}/teams.csv.gz", STANDARD["teams.csv"], fmt="csv")
    assert validate(df, STANDARD["teams.csv"]).filter(f"{STATUS} = 'VALID'").count() == 1


def test_typed_schema_matches_contract():
    schema = STANDARD["tickets.csv"].typed_schema()
    assert schema["created_at"].dataType == T.TimestampNTZType() and schema["refund_amount"].dataType == T.DoubleType()


def test_columns_follow_their_own_header(spark, tmp_path):
    root = tmp_path / "stream" / "2024-01-05"
    for hour, text in (("08", "region_id,region_name,city_id\n1,North,7\n"), ("09", "city_id,region_name,region_id\n8,South,2\n"),
                       ("10", "")):
        (root / hour).mkdir(parents=True)
        (root / hour / "tickets.csv").write_text(text)
    rows = files.read_csv(spark, f"{root}/*/tickets.csv").collect()
    assert {(r.region_id, r.region_name, r.city_id) for r in rows} == {("1", "North", "7"), ("2", "South", "8")}
    found = files.read_stream_hour(spark, f"{tmp_path}/stream", STANDARD, "2024-01-05")["tickets"]
    assert {(r.city_id, r.hour) for r in found.collect()} == {("7", 8), ("8", 9)} and "_metadata" not in found.columns
