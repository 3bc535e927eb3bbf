"""Scans of log text, JSON lines and metric reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.logtext import parse_lines
from millrace.functions.timing import parse_iso

PER_FILE = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("issue_count", T.LongType()),
    T.StructField("is_clean", T.BooleanType()),
    *[T.StructField(f"{c}_issues", T.LongType()) for c in ("null", "type", "enum", "range", "format")],
    T.StructField("missing_cols", T.LongType()),
    T.StructField("elapsed_ms", T.DoubleType()),
])
REPORT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
    T.StructField("started_at", T.StringType()),
    *[T.StructField(n, T.LongType())
      for n in ("files_total", "files_clean", "files_failed", "total_rows", "total_issues")],
    T.StructField("per_file", T.ArrayType(PER_FILE)),
])


def read_log_text(spark: SparkSession, root: str, tail: int | None = None,
                  glob: str = "*.log") -> DataFrame:
    """Raw lines of every log file under ``root`` with ``source_file``; ``tail`` keeps the last
    lines of each file.

    Lines are placed by split start and position inside the split, both known to the scan. The tail is
    cut in every split first and then in the file, so no task orders a whole file, whatever the tail.
    """
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
             .select("value", F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_path").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_split"),
                     F.monotonically_increasing_id().alias("_line")))
    if tail is not None:
        newest = (F.col("_split").desc(), F.col("_line").desc())
        for place in (("_path", "_split"), ("_path",)):
            last = Window.partitionBy(*place).orderBy(*newest)
            lines = lines.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= tail)
    return lines.select("value", "source_file")


def read_logs(spark: SparkSession, root: str, tail: int | None = None, glob: str = "*.log") -> DataFrame:
    """Parsed log lines, newest first."""
    return parse_lines(read_log_text(spark, root, tail, glob)).orderBy(F.col("timestamp").desc_nulls_last())


def read_json_lines(spark: SparkSession, root: str, schema: T.StructType | None = None,
                    glob: str = "*.jsonl") -> DataFrame:
    """Every file named like ``glob`` under ``root``: bad lines dropped, keys of all files merged, a
    ``timestamp`` column parsed."""
    reader = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
              .option("mode", "DROPMALFORMED"))
    df = (reader.schema(schema) if schema is not None else reader).json(root)
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", parse_iso(F.col("timestamp").cast("string")))
    return df


def read_metric_reports(spark: SparkSession, root: str) -> DataFrame:
    """Run reports under ``root``; counters a report lacks are 0, times are parsed."""
    runs = (spark.read.schema(REPORT).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json").option("multiLine", True).json(root)
            .withColumn("source_file", F.col("_metadata.file_name")))
    counters = [f.name for f in REPORT.fields if isinstance(f.dataType, T.LongType)]
    return runs.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in counters},
        "run_id": F.coalesce("run_id", F.lit("?")),
        "recorded_at": F.try_to_timestamp("recorded_at"),
    })
