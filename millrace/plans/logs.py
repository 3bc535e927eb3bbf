"""Questions asked of parsed log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.logtext import LEVEL_RANK


def filter_logs(logs: DataFrame, min_level: str = "DEBUG", logger: str = "", message: str = "",
                last_n: int | None = None) -> DataFrame:
    """Lines at or above a level whose logger and message contain the given text (any case);
    the newest ``last_n`` of them when a report asks for a page."""
    out = logs.filter(F.col("level_rank") >= LEVEL_RANK.get(min_level.upper(), 0))
    if logger:
        out = out.filter(F.lower("logger").contains(logger.lower()))
    if message:
        out = out.filter(F.lower("message").contains(message.lower()))
    if last_n is None:
        return out
    ties = [c for c in ("level", "logger", "message", "source_file") if c in logs.columns]
    return out.orderBy(F.col("timestamp").desc_nulls_last(), *ties).limit(last_n)


def count_by_level(logs: DataFrame) -> DataFrame:
    return (logs.filter(F.col("level").isNotNull()).groupBy("level")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("count", "level"))


def timeline(events: DataFrame, at: str = "timestamp") -> DataFrame:
    """Events per minute from the first to the last, quiet minutes as 0.

    The spine is built day by day and then by minute of day, so its length follows the time span
    and no row holds more than one day.
    """
    stamped = events.filter(F.col(at).isNotNull()).select(F.col(at).cast("timestamp_ntz").alias("_at"))
    counts = stamped.groupBy(_minute("_at").alias("minute")).agg(F.count(F.lit(1)).alias("count"))
    span = counts.agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    days = span.select("first", "last", F.explode(F.sequence(
        F.to_date("first"), F.to_date("last"), F.expr("interval 1 day"))).alias("day")).repartition("day")
    spine = (days.select("first", "last", "day",
                         F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("m"))
             .select("first", "last", F.timestamp_add(
                 "MINUTE", F.col("m"), F.col("day").cast("timestamp_ntz")).alias("minute"))
             .filter(F.col("minute").between(F.col("first"), F.col("last"))))
    return (spine.select("minute").join(counts, "minute", "left")
            .select("minute", F.coalesce("count", F.lit(0)).alias("count")))


def _minute(c: str):
    return F.date_trunc("minute", c).cast("timestamp_ntz")


def windowed_counts(events: DataFrame, at: str, late: str = "10 minutes") -> DataFrame:
    """Streaming form of the timeline: closed minutes, late rows up to ``late`` counted."""
    stamped = events.withColumn(at, F.col(at).cast("timestamp"))  # watermarks need a zoned type
    return (stamped.withWatermark(at, late).groupBy(F.window(at, "1 minute").alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("minute"), "count"))


def export_csv(logs: DataFrame, path: str) -> None:
    """Log lines as CSV without the rank helper."""
    logs.drop("level_rank").write.mode("overwrite").option("header", True).csv(path)
