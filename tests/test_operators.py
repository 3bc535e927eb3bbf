import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, keys, routing, tracking
from millrace.operators.loading import Lake, insert_if_absent, upsert
from millrace.operators.validation import ORPHAN, REASONS, RETRIES, STATUS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows share one key, some keys are null, some have no lookup row."""
    return spark.range(6000).repartition(5).select(
        F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 30 == 0, None).otherwise(F.col("id") % 40)
        .cast("long").alias("k"), F.col("id").alias("v"))


def lookup(spark):
    return spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_same_for_any_size(spark, skewed, how):
    plain = rows(skewed.join(lookup(spark), "k", how))
    assert rows(joins.lookup_join(skewed, lookup(spark), "k", how)) == plain
    assert rows(joins.lookup_join(skewed, lookup(spark), "k", how, max_rows=5)) == plain


def test_hot_keys_are_spread(spark, skewed):
    assert [r.k for r in joins.hot_keys(skewed, ["k"], 4).collect()] == [7]
    salts = skewed.filter("k = 7").select(joins.spread_salt(skewed, 16).alias("s")).groupBy("s").count()
    assert salts.count() == 16 and salts.agg(F.max("count")).first()[0] < 600
    copies = spark.range(4000).repartition(8).select(F.lit(1).alias("k"))  # exact copies
    assert copies.select(joins.spread_salt(copies, 64).alias("s")).distinct().count() > 1


def test_star_join_over_bound(spark, skewed):
    dims = [(lookup(spark), "k", {"name": "n1"})]
    assert rows(joins.star_join(skewed, dims)) == rows(joins.star_join(skewed, dims, max_rows=1))


def test_not_in_target_both_ways(spark):
    batch, target = spark.range(0, 100).toDF("k"), spark.range(50, 500).toDF("k")
    want = [(i,) for i in range(50)]
    for bound in (1000, 1):
        assert sorted(map(tuple, joins.not_in_target(batch, target, ["k"], bound).collect())) == want


def test_flag_members(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "fk long")
    got = joins.flag_members(df, spark.range(5), "fk", "id", "known").collect()
    assert {r.fk: r.known for r in got} == {1: True, 9: False, None: False}


def test_numbers_follow_order_over_many_ranges(spark):
    df = spark.range(5000).select((F.hash("id").cast("long") * 2 + F.col("id") % 2).alias("k"), "id").repartition(7)
    got = {r.k: r.sk for r in keys.number_rows(df, "k", "sk", 10).collect()}
    assert got == {k: 11 + i for i, k in enumerate(sorted(got))} and len(got) == 5000
    by_key = {r.id: r.sk for r in keys.number_by_key(df, "id", "sk").collect()}
    assert by_key == {i: i + 1 for i in range(5000)}


def test_stable_keys(spark):
    known = spark.createDataFrame([(5, 1), (3, 2)], "id long, sk long")
    got = rows(keys.stable_keys(spark.range(2, 7), known, "id", "sk").select("id", "sk"))
    assert got == [(2, 3), (3, 2), (4, 4), (5, 1), (6, 5)]


# ---- routing ----------------------------------------------------------------------------------

def marked(spark):
    return spark.sql("""
        select * from values
          (1, 'VALID', cast(map() as map<string,array<string>>), 0),
          (2, 'INVALID', map('range', array('a')), 0),
          (3, 'ORPHAN', map('orphan', array('a')), 2),
          (4, 'ORPHAN', map('orphan', array('a')), 3)
        as t(id, _record_status, _error_reasons, _retry_count)""")


def test_route(spark, tmp_path):
    routed = routing.route(marked(spark), "t", "r1", 3, str(tmp_path / "stage"))
    assert routed.valid.columns == ["id"] and rows(routed.valid) == [(1,)]
    assert sorted(r.id for r in routed.quarantine.collect()) == [2, 4]
    expired = routed.quarantine.filter("id = 4").first()
    assert expired[REASONS] == {"orphan": ["a"], "expired_orphan": ["a"]}
    assert [r.id for r in routed.waiting.collect()] == [3]
    routing.write_waiting(routed.waiting, str(tmp_path / "w"), "t", 0)
    again = routing.read_waiting(spark, str(tmp_path / "w"), "t", 0)
    assert again.columns == ["id", RETRIES] and again.first()[RETRIES] == 3
    for _ in range(2):  # a repeated run replaces its own folder
        routing.write_quarantine(routed.quarantine, str(tmp_path / "q"), "t", "2024-01-01", "r1")
    stored = routing.read_quarantine(spark, str(tmp_path / "q"), "t")
    assert stored.count() == 2 and stored.first().pipeline_run_id == "r1"


def test_route_needs_validation_columns(spark):
    with pytest.raises(ValueError):
        routing.route(spark.range(1), "t", "r")


def test_restaged_run_leaves_no_old_rows(spark, tmp_path):
    stage = str(tmp_path / "s")
    routing.route(marked(spark), "t", "r", 3, stage)
    only_valid = marked(spark).withColumn(STATUS, F.lit("VALID"))
    routed = routing.route(only_valid, "t", "r", 3, stage)
    assert routed.valid.count() == 4 and routed.waiting.count() == 0


# ---- loads ------------------------------------------------------------------------------------

@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path), "t_" + tmp_path.name.replace("-", "_"))


def test_insert_absent_is_idempotent(spark, lake):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    first = lake.insert_absent("silver_x", batch, ["id"])
    second = lake.insert_absent("silver_x", batch, ["id"])
    assert (first.attempted, first.inserted, first.skipped) == (3, 2, 1)
    assert (second.inserted, second.skipped) == (0, 3)
    assert rows(lake.read("silver_x")) == [(1, "b"), (2, "c")]


def test_composite_key_and_plain_append(spark, lake):
    batch = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    lake.insert_absent("x", batch, ["a", "b"])
    lake.insert_absent("x", batch, ["a", "b"])
    assert lake.read("x").count() == 2
    lake.insert_absent("y", batch, [])
    lake.insert_absent("y", batch, [])
    assert lake.read("y").count() == 4


def test_upsert_reads_and_rewrites_one_table(spark, lake):
    lake.upsert("dim", spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), ["id"])
    lake.upsert("dim", spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), ["id"])
    assert rows(lake.read("dim")) == [(1, "a"), (2, "B"), (3, "c")]
    lake.insert_ignore("dim", spark.createDataFrame([(2, "zz"), (4, "d")], "id int, v string"), ["id"])
    assert rows(lake.read("dim")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert lake.missing(["dim", "nope"]) == ["nope"]


def test_partitioned_table(spark, lake):
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "id int, day string")
    lake.append("p", batch, ["day"])
    lake.append("p", spark.createDataFrame([(3, "z")], "id int, day string"), ["day"])
    assert rows(lake.read("p").filter("day = 'z'").select("id")) == [(3,)]


def test_frames(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "id int, v string")
    assert rows(insert_if_absent(new, old, ["id"])) == [(2, "d")]
    assert rows(upsert(new, old, ["id"])) == [(1, "b"), (2, "d")]


def test_tracking(spark):
    files = spark.createDataFrame([("a", "h1"), ("b", "h2")], "file_path string, last_hash string")
    state = tracking.empty_tracking(spark)
    assert tracking.acquirable(files, state).count() == 2
    state = tracking.acquire(state, files, "r1")
    told = spark.createDataFrame([("a", "SUCCESS", "VALIDATED", 5), ("b", "FAILED", "FAILED_SCHEMA", 0)],
                                 "file_path string, status string, current_stage string, record_count int")
    state = tracking.mark(state, told, "r1")
    assert [r.file_path for r in tracking.acquirable(files, state).collect()] == ["b"]
    changed = spark.createDataFrame([("a", "h9")], "file_path string, last_hash string")
    assert tracking.acquirable(changed, state).count() == 1
    state = tracking.acquire(tracking.acquire(state, files, "r1"), files, "r2")
    attempts = {(r.file_path, r.pipeline_run_id): r.attempt_count for r in state.collect()}
    assert attempts == {("a", "r1"): 2, ("b", "r1"): 2, ("a", "r2"): 1, ("b", "r2"): 1}
    assert tracking.acquirable(files, state, 3).count() == 0  # three attempts over all runs
    latest = {r.file_path: r.current_stage for r in tracking.latest_stage(state).collect()}
    assert latest == {"a": "PENDING", "b": "PENDING"}
    assert len(tracking.new_run_id()) == 22


def test_orphan_status_survives_unknown_reason(spark):
    df = marked(spark).withColumn(REASONS, F.expr("cast(map() as map<string,array<string>>)"))
    out = routing.expire_orphans(df, 0).filter(f"{STATUS} = '{ORPHAN}'")
    assert out.count() == 0
