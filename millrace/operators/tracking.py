"""File tracking: which file was processed, by which run, with what outcome."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.loading import upsert

KEYS = ["file_path", "pipeline_run_id"]
SCHEMA = (
    "file_path string, pipeline_run_id string, processed_at timestamp, status string, "
    "current_stage string, record_count int, last_hash string, last_checkpoint string, "
    "retry_num int, attempt_count int"
)
PROCESSING, SUCCESS, FAILED = "PROCESSING", "SUCCESS", "FAILED"


def new_run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now()):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def empty_tracking(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def acquirable(arrived: DataFrame, tracking: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Files to process now. ``arrived`` has ``file_path`` and ``last_hash``.

    Left out: files already processed successfully with the same content, and files that used up
    their attempts over all runs. Both sides hold one row per file, not per record.
    """
    done = (tracking.filter(F.col("status") == SUCCESS)
            .select("file_path", "last_hash").distinct())
    spent = (tracking.groupBy("file_path").agg(F.sum("attempt_count").alias("_tries"))
             .filter(F.col("_tries") >= max_attempts).select("file_path"))
    return (arrived.join(done, ["file_path", "last_hash"], "left_anti")
            .join(spent, "file_path", "left_anti"))


def spent(arrived: DataFrame, tracking: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Arrived files that used up their attempts and were never loaded with their present content."""
    done = tracking.filter(F.col("status") == SUCCESS).select("file_path", "last_hash").distinct()
    tries = (tracking.groupBy("file_path").agg(F.sum("attempt_count").alias("_tries"))
             .filter(F.col("_tries") >= max_attempts).select("file_path"))
    return arrived.join(done, ["file_path", "last_hash"], "left_anti").join(tries, "file_path", "left_semi")


def acquire(tracking: DataFrame, files: DataFrame, run_id: str) -> DataFrame:
    """Tracking after ``files`` are taken by a run; taking a file again raises its attempts."""
    before = tracking.filter(F.col("pipeline_run_id") == run_id).select(
        "file_path", F.col("attempt_count").alias("_before"))
    taken = files.join(before, "file_path", "left").select(
        "file_path",
        F.lit(run_id).alias("pipeline_run_id"),
        F.current_timestamp().alias("processed_at"),
        F.lit(PROCESSING).alias("status"),
        F.lit("PENDING").alias("current_stage"),
        F.lit(0).alias("record_count"),
        "last_hash",
        F.lit(None).cast("string").alias("last_checkpoint"),
        F.lit(0).alias("retry_num"),
        (F.coalesce("_before", F.lit(0)) + 1).alias("attempt_count"),
    )
    return upsert(taken, tracking, KEYS)


def mark(tracking: DataFrame, outcome: DataFrame, run_id: str) -> DataFrame:
    """Tracking after a run reports. ``outcome`` has ``file_path`` and any of ``status``,
    ``current_stage``, ``record_count``."""
    told = [c for c in ("status", "current_stage", "record_count") if c in outcome.columns]
    news = outcome.select(F.col("file_path"), *[F.col(c).alias(f"_{c}") for c in told],
                          F.lit(run_id).alias("pipeline_run_id"), F.lit(True).alias("_told"))
    return (tracking.join(news, KEYS, "left")
            .withColumns({c: F.coalesce(f"_{c}", c).cast(dict(tracking.dtypes)[c]) for c in told})
            .withColumn("processed_at", F.when(F.col("_told"), F.current_timestamp())
                        .otherwise(F.col("processed_at")))
            .select(*tracking.columns))


def latest_stage(tracking: DataFrame) -> DataFrame:
    """Per file: the stage and status of its latest run, PENDING when none was recorded."""
    last = F.max(F.struct("processed_at", "pipeline_run_id", "current_stage", "status")).alias("_last")
    return tracking.groupBy("file_path").agg(last).select(
        "file_path",
        F.coalesce("_last.current_stage", F.lit("PENDING")).alias("current_stage"),
        F.col("_last.status").alias("status"),
        (F.col("_last.status") == SUCCESS).alias("is_processed"),
    )
