"""Append-only ledger of files: what was taken, by which run, and what came of it.

Every event is a new row in the folder of its run, so a run never rewrites what others wrote and runs can go on
side by side. The present state is a view over the events: the last one of each file and run.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import tracking

_EVENTS = T.StructType([
    T.StructField("file_path", T.StringType()), T.StructField("last_hash", T.StringType()),
    T.StructField("event_at", T.TimestampType()), T.StructField("taken", T.BooleanType()),
    T.StructField("status", T.StringType()), T.StructField("current_stage", T.StringType()),
    T.StructField("record_count", T.IntegerType()), T.StructField("error", T.StringType())])
RUN = "pipeline_run_id"
STATE_SQL = """
select file_path, pipeline_run_id, e.event_at as processed_at, e.status, e.current_stage, e.record_count, last_hash,
       cast(null as string) as last_checkpoint, 0 as retry_num, attempt_count
from (select file_path, cast(pipeline_run_id as string) as pipeline_run_id,
             max_by(struct(event_at, status, current_stage, record_count), struct(event_at, not taken)) as e,
             max_by(last_hash, case when taken then event_at end) as last_hash, cast(count_if(taken) as int) as attempt_count
      from {events} group by file_path, pipeline_run_id)"""


class FileLedger:
    """``root`` holds one folder a run. Attempts are counted by the times a file was taken, so one that ends its
    job without a report counts as well."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def events(self) -> DataFrame:
        """All events, with the run they belong to."""
        schema = T.StructType([*_EVENTS.fields, T.StructField(RUN, T.StringType())])
        try:
            return self.spark.read.schema(schema).option("basePath", self.root).parquet(f"{self.root}/{RUN}=*")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, events: DataFrame, run_id: str) -> None:
        events.select(*_EVENTS.names).coalesce(1).write.mode("append").parquet(f"{self.root}/{RUN}={run_id}")

    def take(self, files: DataFrame, run_id: str) -> None:
        """Enter that a run begins with ``files`` (``file_path, last_hash``)."""
        self._append(files.select(
            "file_path", "last_hash", F.current_timestamp().alias("event_at"), F.lit(True).alias("taken"),
            F.lit(tracking.PROCESSING).alias("status"), F.lit("PENDING").alias("current_stage"),
            F.lit(0).alias("record_count"), F.lit(None).cast("string").alias("error")), run_id)

    def report(self, outcome: DataFrame, run_id: str) -> None:
        """Enter what came of files: ``file_path, status, current_stage, record_count, error``."""
        self._append(outcome.select(
            "file_path", F.lit(None).cast("string").alias("last_hash"), F.current_timestamp().alias("event_at"),
            F.lit(False).alias("taken"), "status", "current_stage", F.col("record_count").cast("int").alias("record_count"),
            "error"), run_id)

    def state(self) -> DataFrame:
        """One row for each file and run, in the columns of the tracking table."""
        return self.spark.sql(STATE_SQL, events=self.events())

    def publish(self, name: str) -> None:
        """The state as a view of the catalog, which always shows the present events."""
        self.spark.sql(f"create or replace view {name} as " + STATE_SQL.format(events=f"parquet.`{self.root}`"))

    def due(self, arrived: DataFrame, max_attempts: int = 3) -> DataFrame:
        """Of ``arrived`` (``file_path, last_hash``, ..) the files to work on: not loaded with this content, attempts left."""
        return tracking.acquirable(arrived, self._of(arrived), max_attempts)

    def spent(self, arrived: DataFrame, max_attempts: int = 3) -> DataFrame:
        return tracking.spent(arrived, self._of(arrived), max_attempts)

    def _of(self, arrived: DataFrame) -> DataFrame:
        """The state of files in ``arrived`` alone."""
        return self.state().join(arrived.select("file_path").distinct(), "file_path", "left_semi")

    def failed(self, pattern: str, max_attempts: int = 3) -> DataFrame:
        """``file_path, last_hash`` of files whose path fits ``pattern`` (a regular expression), whose last run did not succeed
        and that have attempts left."""
        mine = self.state().filter(F.regexp_like("file_path", F.lit(pattern)))
        last = mine.groupBy("file_path").agg(
            F.max_by(F.struct("status", "last_hash"), F.struct("processed_at", RUN)).alias("_l"), F.sum("attempt_count").alias("_n"))
        return last.filter((F.col("_l.status") != tracking.SUCCESS) & (F.col("_n") < max_attempts)).select("file_path", "_l.last_hash")
