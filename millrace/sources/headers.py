"""CSV files matched to columns by the header each file has, whatever the number of files.

All header lines come from one scan; only different column names reach the driver. Rows are read by place, by
one scan for all files, and take their values from the place that their file's header gives a column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import lookup_join
from millrace.session import staged

FORMAT = {"escape": '"'}


def header_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, header``: the first line of every file that is not blank, found in the file's first split.
    A file without any has no row."""
    lines = (spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"),
                                          F.col("_metadata.file_block_start").alias("start"))
             .filter((F.col("start") == 0) & (F.trim("value") != ""))
             .withColumn("at", F.monotonically_increasing_id()))  # rises along a split
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _places(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width))


def headers(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, int]:
    """(``file, names``, most columns): the column names of every file, by place; written once."""
    lines = staged(header_lines(spark, path), "header-lines")
    width = lines.agg(F.max(F.length("header") - F.length(F.replace("header", F.lit(","), F.lit(""))) + 1)).first()[0] or 1
    split = F.from_csv("header", F.lit(_places(width)), FORMAT)
    return lines.select("file", F.array(*[split[f"c{i}"] for i in range(width)]).alias("names")), width


def all_names(heads: DataFrame) -> list[str]:
    """The different column names, in the order of the files and of their headers; case does not count."""
    each = heads.select("file", F.posexplode("names").alias("at", "name")).filter(F.col("name").isNotNull())
    first = each.groupBy(F.lower("name").alias("low")).agg(F.min(F.struct("file", "at", "name")).alias("first"))
    return [r.name for r in first.orderBy("first").select("first.name").collect()]


def lacking(heads: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """``file, missing``: the wanted columns that a file's header does not name."""
    named = F.transform(F.col("names"), F.lower)
    return heads.select("file", F.filter(F.array(*[F.lit(n) for n in wanted]),
                                         lambda n: ~F.coalesce(F.array_contains(named, F.lower(n)), F.lit(False))).alias("missing"))


def _value(name: str, cells: Column, names: Column) -> Column:
    at = F.array_position(F.transform(names, F.lower), name.lower())
    return F.when(at > 0, F.get(cells, (at - 1).cast("int")))


def rows_by_header(spark: SparkSession, path: str | list[str], heads: DataFrame, width: int,
                   columns: Iterable[str] | None = None) -> DataFrame | None:
    """``columns`` (all that any file names) of all files as text, and ``_metadata``; a column that a file lacks
    is null there. None where no file has a header.

    Files with one header are a plain scan. Else most files share one, and only those with another one are looked
    up, by a broadcast while they are few."""
    most = heads.groupBy("names").count().orderBy(F.desc("count"), "names").limit(2).collect()
    if not most:
        return None
    usual = most[0]["names"]
    named = [n if n is not None else f"_c{i}" for i, n in enumerate(usual)]
    text = spark.read.options(header=True, enforceSchema=True, **FORMAT)
    if len(most) == 1 and len({n.lower() for n in named}) == len(named):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in named])
        by_name = {n.lower(): n for n in named}
        kept = [(c, by_name.get(c.lower())) for c in columns] if columns is not None else [(n, n) for n in named]
        return text.schema(schema).csv(path).select(
            *[F.col(f"`{n}`").alias(c) if n else F.lit(None).cast("string").alias(c) for c, n in kept], "_metadata")
    columns = list(columns) if columns is not None else all_names(heads)
    rows = text.schema(_places(width)).csv(path).select(
        F.array(*[F.col(f"c{i}") for i in range(width)]).alias("cells"), "_metadata", F.col("_metadata.file_path").alias("file"))
    common = F.array(*[F.lit(n) for n in usual]).cast("array<string>")
    rows = lookup_join(rows, heads.filter(~F.col("names").eqNullSafe(common)), "file")
    names = F.coalesce("names", common)
    return rows.select(*[_value(c, F.col("cells"), names).alias(c) for c in columns], "_metadata")


def read_by_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All files of ``path`` as one table of text with every column that any file names, and ``_metadata``;
    without any header a table without columns."""
    rows = rows_by_header(spark, path, *headers(spark, path))
    return spark.createDataFrame([], T.StructType([])) if rows is None else rows
