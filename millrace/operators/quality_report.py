"""Column-level quality report: issues counted per column, file and run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contract import FileContract
from millrace.functions import rules
from millrace.functions.money import percent

# ---- fixed values -----------------------------------------------------------------------------
CHECKS = ("missing", "null", "type", "enum", "range", "format")
ISSUE_TYPE = {
    "missing": "schema_mismatch",
    "null": "null_value",
    "type": "schema_mismatch",
    "enum": "invalid_format",
    "range": "out_of_range",
    "format": "invalid_format",
}
CLEAN_RATE_TARGET = 95.0
# ---------------------------------------------------------------------------------------------
MEASURES = ("null_issues", "type_issues", "enum_issues", "range_issues", "format_issues",
            "missing_cols", "total_rows", "issue_count")


def _checks(df: DataFrame, contract: FileContract) -> list[tuple[str, str, Column]]:
    have = {f.name: f.dataType for f in df.schema.fields}
    found: list[tuple[str, str, Column]] = []
    for rule in contract.columns:
        if rule.name not in have:
            found.append((rule.name, "missing", F.lit(1).cast("bigint")))
            continue
        is_text = isinstance(have[rule.name], T.StringType)
        c = rules.null_tokens(F.col(rule.name), rules.NULL_TOKENS) if is_text else F.col(rule.name)
        if not rule.nullable:
            found.append((rule.name, "null", F.count_if(c.isNull())))
        if rule.type != "varchar" and have[rule.name] != rule.spark_type:
            bad = rules.bad_type(c, rules.typed(c, have[rule.name], rule.type))
            found.append((rule.name, "type", F.count_if(bad)))
        if rule.expected_values:
            found.append((rule.name, "enum", F.count_if(rules.bad_enum(c, rule.expected_values))))
        if rule.has_range:
            number = c.try_cast("double")
            bad = rules.bad_range(number, rule.minimum, rule.maximum, "inclusive")
            found.append((rule.name, "range", F.count_if(bad | rules.bad_type(c, number))))
        if rule.format in rules.REPORT_FORMATS:
            bad = rules.bad_format(c.cast("string"), rules.REPORT_FORMATS[rule.format])
            found.append((rule.name, "format", F.count_if(bad)))
    return found


def column_issues(df: DataFrame, contract: FileContract, by: Sequence[str] = ()) -> DataFrame:
    """One row per (column, check), zero counts included, from a single aggregation over the file:
    ``file_name, total_rows, column, check, issue_type, count``. ``by`` counts per partition of the
    file (a date, an hour) in the same pass."""
    checks = _checks(df, contract)
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"),
                                  *[n.alias(f"_{i}") for i, (_, _, n) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                 F.lit(ISSUE_TYPE[check]).alias("issue_type"), F.col(f"_{i}").alias("count"))
        for i, (column, check, _) in enumerate(checks)
    ])
    return counted.select(*by, F.lit(contract.file_name).alias("file_name"), "total_rows",
                          F.inline(rows))


def report_issues(tables: Sequence[tuple[DataFrame, FileContract]], by: Sequence[str] = ()) -> DataFrame:
    """Issues of several files as one plan."""
    return reduce(DataFrame.unionByName, [column_issues(df, c, by) for df, c in tables])


def per_file_metrics(issues: DataFrame, run_id: str | Column, keys: Sequence[str] = ("file_name",),
                     elapsed_ms: Column | None = None) -> DataFrame:
    """One row per file: issue counts by category."""

    def total(check: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("check") == check, F.col("count"))), F.lit(0))

    return issues.groupBy(*keys).agg(
        F.max("total_rows").alias("total_rows"),
        F.sum("count").alias("issue_count"),
        (F.sum("count") == 0).alias("is_clean"),
        *[total(c).alias(f"{c}_issues") for c in ("null", "type", "enum", "range", "format")],
        total("missing").alias("missing_cols"),
    ).withColumns({
        "run_id": F.lit(run_id) if isinstance(run_id, str) else run_id,
        "elapsed_ms": elapsed_ms if elapsed_ms is not None else F.lit(None).cast("double"),
    })


def run_snapshot(per_file: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """One row per run: files and rows seen, issues found, and the per-file rows nested."""
    nested = F.struct(*[c for c in per_file.columns if c not in keys])
    return per_file.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if("is_clean").alias("files_clean"),
        F.count_if(~F.col("is_clean")).alias("files_failed"),
        F.sum("total_rows").alias("total_rows"),
        F.sum("issue_count").alias("total_issues"),
        F.sort_array(F.collect_list(nested)).alias("per_file"),  # one struct per contract file
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs with their clean rate, newest first when ``recorded_at`` is known."""
    rated = runs.withColumn("clean_rate",
                            percent(F.col("files_clean"), F.greatest("files_total", F.lit(1)), 1))
    if "recorded_at" in runs.columns:
        return rated.orderBy(F.col("recorded_at").desc_nulls_last())
    return rated


def clean_rate_trend(summary: DataFrame, at: str = "recorded_at") -> DataFrame:
    """Clean rate over time, oldest first, with the distance to the target."""
    gap = F.round(F.col("clean_rate") - F.lit(CLEAN_RATE_TARGET), 1)
    return summary.select(at, "clean_rate", gap.alias("gap_to_target")).orderBy(at)


def explode_runs(runs: DataFrame) -> DataFrame:
    """Nested reports back to one row per run and file."""
    return runs.select("run_id", F.explode("per_file").alias("f")).select("run_id", "f.*")


def issue_totals(per_file: DataFrame) -> DataFrame:
    """Eight measures summed per file over all runs, most issues first."""
    return (per_file.groupBy("file_name").agg(*[F.sum(m).alias(m) for m in MEASURES])
            .orderBy(F.col("issue_count").desc(), "file_name"))


def worst_files(per_file: DataFrame, top: int = 10) -> DataFrame:
    """The files with most issues; ``top`` is the report's length."""
    return issue_totals(per_file).filter("issue_count > 0").limit(top)


def write_report(snapshot: DataFrame, root: str) -> None:
    """One JSON report per run under ``root/run_id=<run>``."""
    (snapshot.withColumn("_run", F.col("run_id")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_run").json(root))
