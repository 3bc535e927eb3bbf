"""Three-way routing of validated rows, the quarantine, and the waiting room for orphans."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.validation import (
    EXPIRED, INVALID, NO_REASONS, ORPHAN, REASONS, RETRIES, STATUS, VALID,
)
from millrace.session import CODEC

RUN_ID, PROCESSED_AT = "pipeline_run_id", "_processed_at"


@dataclass
class Routed:
    valid: DataFrame       # business columns only
    quarantine: DataFrame  # invalid rows and expired orphans
    waiting: DataFrame     # orphans that will be retried


def expire_orphans(df: DataFrame, max_retries: int) -> DataFrame:
    """Orphans that used up their retries become INVALID; the lost columns are named under
    ``expired_orphan`` in the reasons."""
    expired = (F.col(STATUS) == ORPHAN) & (F.col(RETRIES) >= max_retries)
    lost = F.coalesce(F.col(REASONS)["orphan"], F.expr("cast(array() as array<string>)"))
    return df.withColumns({
        STATUS: F.when(expired, INVALID).otherwise(F.col(STATUS)),
        REASONS: F.when(expired, F.map_concat(REASONS, F.create_map(F.lit(EXPIRED), lost)))
        .otherwise(F.col(REASONS)),
    })


def add_audit(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({RUN_ID: F.lit(run_id), PROCESSED_AT: F.current_timestamp()})


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_") or c == RUN_ID])


def split_by_status(df: DataFrame) -> Routed:
    """Filter one validated table three ways. Pass a staged table (see :func:`stage_by_status`)
    so the three branches read back their own partition instead of validating three times."""
    return Routed(
        valid=drop_bookkeeping(df.filter(F.col(STATUS) == VALID)),
        quarantine=df.filter(F.col(STATUS) == INVALID),
        waiting=df.filter(F.col(STATUS) == ORPHAN),
    )


def prepare_routing(df: DataFrame, table_name: str, run_id: str, max_retries: int = 3) -> DataFrame:
    """Check the validation columns, expire old orphans, add the audit columns."""
    lacking = [c for c in (STATUS, REASONS, RETRIES) if c not in df.columns]
    if lacking:
        raise ValueError(f"{table_name} lacks validation columns {lacking}")
    return add_audit(expire_orphans(df, max_retries), run_id)


def stage_by_status(df: DataFrame, path: str) -> DataFrame:
    """Write the validated rows once, one folder per status, and read them back."""
    schema = df.schema
    # static: a repeated run must not leave rows of an earlier outcome behind
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
     .partitionBy(STATUS).parquet(path))
    return df.sparkSession.read.schema(schema).parquet(path).select(*df.columns)


def route(df: DataFrame, table_name: str, run_id: str, max_retries: int = 3,
          stage: str | None = None, stage_valid: bool = True) -> Routed:
    """Without ``stage_valid`` only the rows that are not valid are written to ``stage``; ``df`` is evaluated
    again where the valid ones are read. It must come from written tables, so that it has the same outcome then."""
    ready = prepare_routing(df, table_name, run_id, max_retries)
    if not stage:
        return split_by_status(ready)
    if stage_valid:
        return split_by_status(stage_by_status(ready, stage))
    others = split_by_status(stage_by_status(ready.filter(F.col(STATUS) != VALID), stage))
    return Routed(split_by_status(ready).valid, others.quarantine, others.waiting)


def write_quarantine(df: DataFrame, root: str, table_name: str, process_date: str, run_id: str) -> None:
    """One folder per table, day and run: ``root/table_name=/process_date=/pipeline_run_id=``. A
    repeated run replaces its own folder."""
    folder = f"{root}/table_name={table_name}/process_date={process_date}/{RUN_ID}={run_id}"
    df.drop(RUN_ID).write.mode("overwrite").option("compression", CODEC).parquet(folder)


def read_quarantine(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    """Everything quarantined for one table; folders of other tables are not listed."""
    stored = spark.read.option("basePath", root).parquet(f"{root}/table_name={table_name}")
    return stored.withColumns({c: F.col(c).cast("string") for c in ("process_date", RUN_ID)})


class WaitingRoom:
    """Orphans of one contract under ``folder``, complete after every cycle: ``cycle=../state=..``.

    A cycle reads what an earlier one left and writes a folder of its own; one that is tried again, or replayed, adds
    a further state. Nothing is overwritten or removed, so whoever reads a room goes on undisturbed and a
    replayed cycle reads the same input. Streams number cycles by batch, batch loads one after the other.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _highest(self, folder: str, step: str, before: int | None = None) -> int:
        """The highest number of a step in the paths below ``folder``, -1 without any. By path: an empty room has no rows."""
        try:
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1
        number = F.regexp_extract("path", rf"/{step}=(\d+)/", 1).try_cast("int")
        found = listed.select(number.alias("c")).filter(F.col("c") < before if before is not None else F.lit(True))
        highest = found.agg(F.max("c")).first()[0]
        return -1 if highest is None else int(highest)

    def last(self, before: int | None = None) -> int:
        """The latest cycle that left a room (below ``before``), -1 without any."""
        return self._highest(self.folder, "cycle", before)

    def left_by(self, cycle: int) -> DataFrame | None:
        """Orphans left by a cycle, the retry counter raised and the audit columns removed; None if it left no room."""
        folder = f"{self.folder}/cycle={cycle}"
        state = self._highest(folder, "state")
        if state < 0:
            return None
        waiting = self.spark.read.parquet(f"{folder}/state={state}")
        return (waiting.withColumn(RETRIES, F.col(RETRIES) + 1)
                .drop(RUN_ID, PROCESSED_AT, STATUS, REASONS))

    def leave(self, df: DataFrame, cycle: int) -> None:
        folder = f"{self.folder}/cycle={cycle}"
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{folder}/state={self._highest(folder, 'state') + 1}")


def write_waiting(df: DataFrame, root: str, table_name: str, cycle: int) -> None:
    """Orphans after cycle ``cycle``: the complete waiting room (see :class:`WaitingRoom`)."""
    WaitingRoom(df.sparkSession, f"{root}/{table_name}").leave(df, cycle)


def read_waiting(spark: SparkSession, root: str, table_name: str, cycle: int) -> DataFrame:
    """Orphans left by ``cycle``, with the retry counter raised and the audit columns removed."""
    return WaitingRoom(spark, f"{root}/{table_name}").left_by(cycle)


def as_text_like(waiting: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Typed waiting rows in the column types of the raw source, so they are validated like it."""
    return waiting.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in waiting.columns])


def with_reasons(df: DataFrame, status: str = VALID) -> DataFrame:
    """Give rows that need no validation the three validation columns."""
    return df.withColumns({STATUS: F.lit(status), REASONS: F.expr(NO_REASONS), RETRIES: F.lit(0)})
