"""Files of one contract as one table, each file judged by its own columns.

A file that lacks a column of the contract, has no readable content or breaks off is named with its problem and
gives no rows; all others are read together. Plans and jobs do not grow with the number of files.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import FileContract
from millrace.operators.joins import lookup_join
from millrace.session import CODEC, staged
from millrace.sources.headers import all_names, headers, lacking, rows_by_header

SOURCE = "_source_file"
PROBLEMS = "file_path string, current_stage string, error string"
JSON_OPTIONS = {"allowNonNumericNumbers": "true"}
_BROKEN = re.compile(r"FAILED_READ_FILE[^\]]*\] Encountered error while reading file (\S+?)\.\s")


def plain_path(path: Column) -> Column:
    """A path as listings write it from one in ``_metadata``, which is encoded like a URL."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")


def _is_csv(path: str) -> bool:
    return bool(re.search(r"\.csv(\.\w+)?$", path.lower()))


def _problem(files: DataFrame, stage: str, error: Column) -> DataFrame:
    return files.select("file_path", F.lit(stage).alias("current_stage"), error.alias("error"))


def _mismatch(missing: Column) -> Column:
    return F.concat(F.lit("column_mismatch: "), F.array_join(F.array_sort(missing), ", "))


def _csv(spark: SparkSession, paths: list[str], wanted: list[str], columns: list[str] | None) -> tuple[DataFrame | None, DataFrame]:
    heads, width = headers(spark, paths)
    without = (spark.createDataFrame([(p,) for p in paths], "file_path string")
               .join(heads.select(plain_path(F.col("file")).alias("file_path")), "file_path", "left_anti"))
    short = lacking(heads, wanted).filter(F.size("missing") > 0)
    problems = staged(_problem(without, "FAILED_SCHEMA", F.lit("no header")).union(
        short.select(plain_path(F.col("file")), F.lit("FAILED_SCHEMA"), _mismatch(F.col("missing")))), "problems")
    bad = {r.file_path for r in problems.collect()}
    good = [p for p in paths if p not in bad]
    if not good:
        return None, problems
    fine = heads.join(problems.select(F.col("file_path").alias("bad")), plain_path(F.col("file")) == F.col("bad"), "left_anti")
    rows = rows_by_header(spark, good, fine, width, columns or wanted + [n for n in all_names(fine) if n not in wanted])
    return rows.withColumn(SOURCE, plain_path(F.col("_metadata.file_path"))).drop("_metadata"), problems


def _as_written(value: Column) -> Column:
    """Numbers that are none come out of a JSON map in quotation marks."""
    return F.when(F.regexp_like(value, F.lit('^"[+-]?(NaN|Infinity|INF)"$')), F.trim(value, F.lit('"'))).otherwise(value)


def _json(spark: SparkSession, paths: list[str], wanted: list[str], columns: list[str] | None) -> tuple[DataFrame | None, DataFrame]:
    """An array of records is one value while it is cut into records; the records are written at once."""
    texts = spark.read.text(paths, wholetext=True).select(plain_path(F.col("_metadata.file_path")).alias("file_path"), "value")
    many = F.from_json("value", "array<map<string,string>>", JSON_OPTIONS)
    one = F.from_json("value", "map<string,string>", JSON_OPTIONS)
    records = F.coalesce(many, F.when(F.substring(F.ltrim("value"), 1, 1) == "{", F.array(one)))
    cut = staged(texts.select("file_path", F.explode_outer(records).alias("record")), "records")
    keys = cut.select("file_path", F.explode_outer(F.map_keys("record")).alias("key")).distinct()
    found = keys.groupBy("file_path").agg(F.collect_set("key").alias("keys"))
    missing = F.array_except(F.array(*[F.lit(n) for n in wanted]), F.col("keys"))
    state = found.withColumn("missing", missing)
    problems = staged(_problem(state.filter(F.size("keys") == 0), "FAILED_SCHEMA", F.lit("no records")).union(
        _problem(state.filter((F.size("keys") > 0) & (F.size("missing") > 0)), "FAILED_SCHEMA", _mismatch(F.col("missing")))), "problems")
    if columns is None:
        others = keys.join(problems, "file_path", "left_anti").select("key").distinct().orderBy("key").collect()
        columns = wanted + [r.key for r in others if r.key is not None and r.key not in wanted]
    bad = problems.select("file_path", F.lit(True).alias("bad"))
    rows = lookup_join(cut.filter("record is not null"), bad, "file_path").filter("bad is null")
    return rows.select(*[_as_written(F.col("record")[c]).alias(c) for c in columns], F.col("file_path").alias(SOURCE)), problems


def read_files(spark: SparkSession, paths: Sequence[str], contract: FileContract,
               columns: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of all good files as text with ``_source_file``, ``file_path, current_stage, error`` of the others).

    ``columns`` are kept (by default the contract's and whatever else the good files name); a file must have all
    columns of the contract. A CSV file may order them as it likes. An array of JSON records is cut
    in one task; its records are then a table like any other. A JSON file without any record counts as a
    file without columns.
    """
    columns = list(columns) if columns is not None else None
    parts, problems = [], [spark.createDataFrame([], PROBLEMS)]
    for kind, read in ((True, _csv), (False, _json)):
        mine = sorted(p for p in paths if _is_csv(p) == kind)
        if mine:
            rows, bad = read(spark, mine, contract.names, columns)
            problems.append(bad)
            parts += [rows] if rows is not None else []
    if not parts:
        parts = [spark.createDataFrame([], contract.read_schema([*[c for c in columns or [] if c not in contract.names], SOURCE]))]
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), reduce(DataFrame.union, problems))


def broken_file(error: Exception) -> str | None:
    """The file that a failed job could not read to its end, None where the failure has another reason."""
    named = _BROKEN.search(str(error))
    return named[1] if named else None


def archived(spark: SparkSession, paths: Sequence[str], contract: FileContract, folder: str,
             columns: Iterable[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """:func:`read_files` with the rows written to ``folder`` as the raw copy and read back (None without a good file).

    A file that turns out to be broken while it is read is a problem of its own and left out; any other
    failure is raised."""
    columns = list(columns) if columns is not None else None
    left, broken = list(paths), []
    while True:
        try:
            rows, problems = read_files(spark, left, contract, columns)
            problems = staged(problems, "file-problems")
            problems = problems.union(spark.createDataFrame(broken, PROBLEMS))
            if problems.count() >= len(paths):
                return None, problems
            stamped = rows.withColumn("_ingested_at", F.current_timestamp())
            stamped.write.mode("overwrite").option("compression", CODEC).parquet(folder)
            return spark.read.schema(stamped.schema).parquet(folder), problems
        except Exception as error:  # a file that breaks off; everything else goes on to the caller
            name = broken_file(error)
            name = name and spark.range(1).select(plain_path(F.lit(name))).first()[0]
            if name not in left:
                raise
            left.remove(name)
            broken.append((name, "FAILED", "unreadable"))
            if not left:
                return None, spark.createDataFrame(broken, PROBLEMS)


def arriving_files(spark: SparkSession, root: str, pattern: str, layout: str = "*/*", max_files: int = 10_000) -> DataFrame:
    """Stream of the files below ``root`` whose name fits ``pattern``, not of their rows: ``file_path, last_hash, length``,
    oldest first, at most ``max_files`` a batch. Empty files are left out. No content is read."""
    found = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("pathGlobFilter", pattern).option("latestFirst", False).option("maxFilesPerTrigger", max_files)
             .load(f"{root}/{layout}".rstrip("/")))
    return found.filter("length > 0").select(
        F.col("path").alias("file_path"),
        F.sha2(F.concat_ws("|", "length", F.unix_micros("modificationTime")), 256).alias("last_hash"), "length")
