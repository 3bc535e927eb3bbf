"""Log-line text to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.timing import parse_iso

# ---- fixed values: line layout and level ranks ------------------------------------------------
LINE = (
    r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
    r"\s{2}(\w+)\s+"
    r"\[([^\]]+)\]\s+"
    r"(.+)$"
)
PARTITION = r"Partition:\s*(\S+)"
RESULT = r"→\s*(CLEAN|ISSUES=(\d+))\s+rows=(\d+).*?\[(\d+(?:\.\d+)?)ms\]"
LEVEL_RANK = {"DEBUG": 0, "INFO": 1, "WARNING": 2, "WARN": 2, "ERROR": 3, "CRITICAL": 4}
UNKNOWN_LEVEL_RANK = 1
# ---------------------------------------------------------------------------------------------


def level_rank(level: Column) -> Column:
    rank = F.lit(UNKNOWN_LEVEL_RANK)
    for name, value in LEVEL_RANK.items():
        rank = F.when(level == name, value).otherwise(rank)
    return rank.cast("tinyint")


def parse_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """One row per well-formed line: timestamp, level, logger, message, level_rank.

    Other lines are dropped. Columns of ``df`` other than ``line`` are kept.
    """
    text = F.rtrim(F.col(line))
    keep = [c for c in df.columns if c != line]
    level = F.upper(F.regexp_extract(text, LINE, 2))
    return df.filter(text.rlike(LINE)).select(
        parse_iso(F.regexp_extract(text, LINE, 1)).alias("timestamp"),
        level.alias("level"),
        F.regexp_extract(text, LINE, 3).alias("logger"),
        F.trim(F.regexp_extract(text, LINE, 4)).alias("message"),
        level_rank(level).alias("level_rank"),
        *keep,
    )


def partition_name(message: Column) -> Column:
    """Partition a message names, empty text when it names none."""
    return F.regexp_extract(message, PARTITION, 1)


def file_result(message: Column) -> dict[str, Column]:
    """Result columns of a per-file message; all null for other messages."""
    hit = message.rlike(RESULT)

    def part(group: int) -> Column:
        return F.when(hit, F.regexp_extract(message, RESULT, group))

    return {
        "is_clean": part(1) == "CLEAN",
        "issue_count": F.when(hit, F.coalesce(part(2).try_cast("bigint"), F.lit(0))),
        "rows": part(3).try_cast("bigint"),
        "elapsed_ms": part(4).try_cast("double"),
    }
