from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions import masking, money, rules, timing
from millrace.functions.logtext import file_result, parse_lines, partition_name


def one(df):
    return df.collect()[0]


def test_minutes_count_boundaries(spark):
    rows = [(datetime(2024, 1, 1, 10, 0, 59), datetime(2024, 1, 1, 10, 1, 0)),
            (datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 10, 0, 59)),
            (datetime(2024, 1, 2, 0, 0, 0), datetime(2024, 1, 1, 23, 59, 59)),
            (datetime(2023, 12, 31, 23, 59, 0), datetime(2024, 1, 1, 1, 0, 0)),
            (datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(timing.minutes_between(F.col("a"), F.col("b")),
                    timing.elapsed_minutes(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 0), (-1, 0), (61, 61), (None, None)]


def test_breach_at_limit_is_not_a_breach(spark):
    df = spark.createDataFrame([(15, 1), (16, 1), (None, None)], "m int, hit int")
    got = [r[0] for r in df.select(timing.breached(F.col("m"), 15, F.col("hit"))).collect()]
    assert got == [False, True, None]


def test_refund_pct(spark):
    rows = [(5.0, 10.0), (None, 10.0), (1.0, 0.0), (1.0, None), (100.0, 5.0), (1.0, 3.0), (1.0, 800.0),
            (-5.0, 100.0)]
    df = spark.createDataFrame(rows, "r double, t double")
    got = [r[0] for r in df.select(money.refund_pct(F.col("r"), F.col("t"))).collect()]
    assert got == [Decimal("50.00"), Decimal("0.00"), None, None, None, Decimal("33.33"),
                   Decimal("0.13"), Decimal("-5.00")]


def test_percent_and_ratio_round_half_up(spark):
    df = spark.createDataFrame([(201, 20000), (1, 32), (0, 0)], "k bigint, n bigint")
    got = [tuple(r) for r in df.select(money.percent(F.col("k"), F.col("n")),
                                       money.ratio(F.col("k"), F.col("n"))).collect()]
    assert got == [(1.01, 0.01), (3.13, 0.03), (None, None)]


def test_money_overflow_is_null(spark):
    df = spark.createDataFrame([(1e20,), (1.005,)], "a double")
    assert [r[0] for r in df.select(money.money(F.col("a"))).collect()] == [None, Decimal("1.01")]


def test_try_type(spark):
    df = spark.createDataFrame([("12.0",), ("12.5",), (" 1",), ("-3",), ("x",), ("12\n",)], "v string")
    assert [r[0] for r in df.select(rules.try_type(F.col("v"), "integer")).collect()] == [
        12, None, None, -3, None, None]
    df = spark.createDataFrame([("yes",), ("TRUE",), ("0",)], "v string")
    assert [r[0] for r in df.select(rules.try_type(F.col("v"), "boolean")).collect()] == [None, True, False]
    df = spark.createDataFrame([("2024-13-01 x",), ("2024-01-02",), ("2024-01-02T03:04:05",)], "v string")
    assert [r[0] for r in df.select(rules.try_type(F.col("v"), "timestamp")).collect()] == [
        None, datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)]


def test_range_bounds(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (1.0,), (None,)], "v double")
    both = df.select(rules.bad_range(F.col("v"), 0, 1), rules.bad_range(F.col("v"), 0, 1, "inclusive")).collect()
    assert [tuple(r) for r in both] == [(True, False), (False, False), (True, False), (False, False)]


def test_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(rules.nan_to_null(F.col("v"))).collect()] == [None, 1.0]


def test_masks(spark):
    df = spark.createDataFrame([("ab",), ("01012345678",), (None,)], "v string")
    got = df.select(*[masking.mask(F.col("v"), k).alias(k)
                      for k in ("partial_prefix_3", "last_four", "redact", "hash")]).collect()
    assert tuple(got[0])[:3] == ("ab", "ab", "[REDACTED]")
    assert got[1][0] == "010********" and got[1][1] == "************5678"
    assert tuple(got[2]) == (None, None, "[REDACTED]", None)
    mail = spark.createDataFrame([("a.b@x.org",)], "v string")
    assert one(mail.select(masking.mask(F.col("v"), "partial_email")))[0] == "***@x.org"


def test_log_lines(spark):
    lines = ["2026-04-10T08:00:01  WARNING   [loader]  text here  ", "no log line", "",
             "2026-04-10T08:00:02  odd  [x]  → ISSUES=3 rows=10 null=3 [1.5ms]",
             "2026-99-10T08:00:02  ERROR  [x]  Partition: stream/2026-04-10/08  (3 files)"]
    df = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = df.collect()
    assert [(r.level, r.level_rank, r.logger) for r in rows] == [
        ("WARNING", 2, "loader"), ("ODD", 1, "x"), ("ERROR", 3, "x")]
    assert rows[0].message == "text here" and rows[2].timestamp is None
    result = df.select(*[c.alias(n) for n, c in file_result(F.col("message")).items()],
                       partition_name(F.col("message")).alias("p")).collect()
    assert tuple(result[1]) == (False, 3, 10, 1.5, "")
    assert result[0][0] is None and result[2].p == "stream/2026-04-10/08"
