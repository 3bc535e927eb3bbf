"""Contract-driven scans of CSV and JSON files, by folder layout, batch and streaming.

Text is read as text: no type is inferred, so leading zeros survive and bad values reach the row
rules instead of failing the scan. Date and hour folders are selected through the path, so other
folders are not even listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contract import ContractBook, FileContract
from millrace.functions import rules
from millrace.session import CODEC
from millrace.sources.headers import read_by_header

SUPPORTED = ("csv", "json")
FOLDERS = r"(\d{4}-\d{2}-\d{2})/(\d{1,2})/[^/]+\z"


def file_format(name: str) -> str | None:
    """``csv`` or ``json`` from the extension, None for anything else."""
    ext = name.rsplit(".", 1)[-1].lower() if "." in name.rsplit("/", 1)[-1] else ""
    return ext if ext in SUPPORTED else None


def empty_source(spark: SparkSession, contract: FileContract) -> DataFrame:
    return spark.createDataFrame([], contract.read_schema())


def clean_nulls(df: DataFrame, tokens: Sequence[str] = rules.BLANK_TOKENS,
                columns: Iterable[str] | None = None) -> DataFrame:
    """Replace spellings of "no value" by null in the text columns."""
    wanted = set(columns) if columns is not None else None
    texts = [n for n, t in df.dtypes
             if t == "string" and not n.startswith("_") and (wanted is None or n in wanted)]
    return df.withColumns({n: rules.null_tokens(F.col(n), tokens) for n in texts}) if texts else df


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             keep_file: bool = False) -> DataFrame:
    """CSV with a header, every column text. A given schema is checked against the header.

    Without a schema every file keeps the meaning of its own header: columns are matched by name, a column that
    a file lacks is null there, and the number of jobs does not grow with the files (see
    :mod:`millrace.sources.headers`). ``keep_file`` keeps ``_metadata`` as a column."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    rows = read_by_header(spark, path)
    return rows if keep_file else rows.drop("_metadata")


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
              array: bool = True, keep_file: bool = False) -> DataFrame:
    """JSON with every value as text: one array (or object) per file, or one object per line.

    Without a schema the column names are discovered by a first pass over the files.
    """
    reader = (spark.read.option("multiLine", array).option("allowNonNumericNumbers", True)
              .option("primitivesAsString", True))
    rows = (reader.schema(schema) if schema is not None else reader).json(path)
    return rows.select("*", "_metadata") if keep_file else rows


def read_source(spark: SparkSession, path: str | list[str], contract: FileContract, *,
                fmt: str | None = None, schema: T.StructType | None = None, array: bool = True,
                tokens: Sequence[str] = rules.BLANK_TOKENS, keep_file: bool = False) -> DataFrame:
    """Scan one contract file. Missing, empty and unsupported files give no rows."""
    first = path if isinstance(path, str) else (path[0] if path else "")
    kind = fmt or file_format(first)
    if kind is None or not first:
        return empty_source(spark, contract)
    try:
        df = (read_csv(spark, path, schema, keep_file) if kind == "csv"
              else read_json(spark, path, schema, array, keep_file))
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty_source(spark, contract)
        raise
    if not df.columns:
        return empty_source(spark, contract)
    return clean_nulls(df, tokens)


def with_source(df: DataFrame) -> DataFrame:
    """Add ``_source_file`` and the ``date`` and ``hour`` its folders name."""
    path = F.col("_metadata.file_path")
    return df.withColumns({
        "_source_file": path,
        "date": F.nullif(F.regexp_extract(path, FOLDERS, 1), F.lit("")),
        "hour": F.regexp_extract(path, FOLDERS, 2).try_cast("int"),
    }).drop("_metadata")


def read_folder(spark: SparkSession, root: str, contracts: Iterable[FileContract],
                tokens: Sequence[str] = rules.NULL_TOKENS) -> dict[str, DataFrame]:
    """Flat folder (master or batch): one DataFrame per contract file that is there, CSV or JSON."""
    found = {}
    for contract in contracts:
        for ext in SUPPORTED:
            df = read_source(spark, f"{root}/{contract.stem}.{ext}", contract, tokens=tokens, keep_file=True)
            if "_metadata" in df.columns:  # not an empty stand-in
                found[contract.stem] = df.drop("_metadata")
    return found


def read_stream_hour(spark: SparkSession, root: str, book: ContractBook, date: str,
                     hour: int | None = None, tokens: Sequence[str] = rules.NULL_TOKENS
                     ) -> dict[str, DataFrame]:
    """``root/date/HH/file``: one DataFrame per stream file, all hours when none is given."""
    folder = f"{int(hour):02d}" if hour is not None else "*"
    found = {}
    for contract in book.section("stream"):
        df = read_source(spark, f"{root}/{date}/{folder}/{contract.file_name}", contract, tokens=tokens,
                         keep_file=True)
        if "_metadata" in df.columns:
            found[contract.stem] = with_source(df)
    return found


def read_stream_all(spark: SparkSession, root: str, book: ContractBook,
                    tokens: Sequence[str] = rules.NULL_TOKENS) -> dict[str, DataFrame]:
    """Every date and hour under ``root``."""
    return read_stream_hour(spark, root, book, "*", None, tokens)


def read_all_sources(spark: SparkSession, root: str, book: ContractBook, date: str,
                     hour: int | None = None, include_batch: bool = True
                     ) -> dict[str, dict[str, DataFrame]]:
    """Everything of a date: ``{"stream": .., "batch": .., "master": ..}`` by file stem."""
    found = {"stream": read_stream_hour(spark, f"{root}/stream", book, date, hour)}
    if include_batch:
        found["batch"] = read_folder(spark, f"{root}/batch", book.section("batch"))
        found["master"] = read_folder(spark, f"{root}/master", book.section("batch"))
    return {k: v for k, v in found.items() if v}


def stream_source(spark: SparkSession, root: str, contract: FileContract, *,
                  extra: Iterable[str] = (), layout: str = "*/*", fmt: str | None = None,
                  max_files: int | None = None, array: bool = True) -> DataFrame:
    """Streaming scan of one contract file under ``root/date/HH``; oldest files come first."""
    kind = fmt or file_format(contract.file_name)
    reader = (spark.readStream.schema(contract.read_schema(extra))
              .option("pathGlobFilter", f"{contract.stem}.*").option("latestFirst", False))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = f"{root}/{layout}".rstrip("/")
    if kind == "csv":
        df = (reader.option("header", True).option("enforceSchema", False)
              .option("escape", '"').csv(path))
    else:
        df = reader.option("multiLine", array).option("allowNonNumericNumbers", True).json(path)
    return clean_nulls(with_source(df))


def archive_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """Bronze copy of a raw file: text columns plus source and arrival time, split by date and
    hour. ``mode="overwrite"`` replaces only the dates and hours present in ``df``.

    Rows are rebalanced by folder first: few files per hour, and a heavy hour is split over several
    tasks at run time.
    """
    (df.withColumn("_ingested_at", F.current_timestamp()).hint("rebalance", "date", "hour").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy("date", "hour").parquet(path))


def hash_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of whole files, each read as one value, so for files well below 2 GB; see
    :func:`fingerprint_files`. ``file_path, last_hash, length``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path").alias("file_path"), F.sha2("content", 256).alias("last_hash"), "length")


def fingerprint_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``file_path, last_hash, length`` of every file below ``path``, from length and modification time:
    no content is read, whatever the size. A file written again counts as changed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path").alias("file_path"),
        F.sha2(F.concat_ws("|", "length", F.unix_micros("modificationTime")), 256).alias("last_hash"), "length")


def delivered_name(path: Column) -> Column:
    """Name of the delivered file a path belongs to: its last part, or the folder of a part that Spark wrote
    (``orders.csv/part-00000-..``)."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    return F.when(last.startswith("part-") & (F.size(steps) > 1), F.element_at(steps, -2)).otherwise(last)


def known_files(files: DataFrame, book: ContractBook, path: str = "file_path") -> DataFrame:
    """Files the contracts know, empty ones left out; a file may come as CSV or JSON."""
    stems = [c.stem for c in book.contracts]
    return files.filter(F.regexp_extract(delivered_name(F.col(path)), r"^(.*)\.(csv|json)\z", 1).isin(*stems)
                        & (F.col("length") > 0))
