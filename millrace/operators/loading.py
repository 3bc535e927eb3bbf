"""Idempotent table loads on Parquet tables in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.buckets import BUCKETS, BucketedTable
from millrace.operators.joins import fits_broadcast, not_in_target
from millrace.operators.validation import flag_duplicates
from millrace.session import CODEC, scratch_path, staged

MOST_BUCKETS = 1024


@dataclass
class LoadResult:
    table_name: str
    attempted: int = 0
    inserted: int = 0

    @property
    def skipped(self) -> int:
        return self.attempted - self.inserted


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """Keep the last row of every key (all columns in turn decide when no order is given)."""
    order = order_by or [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    return flag_duplicates(df, keys, order, "keep_last", "_dup").filter(~F.col("_dup")).drop("_dup")


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: one per key, and only keys the target does not hold."""
    return not_in_target(one_per_key(batch, keys), target, keys)


def upsert(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after a type-1 upsert: rows of the batch win, all other rows stay."""
    fresh = one_per_key(batch, keys)
    gone = fresh.select(*keys)
    kept = target.join(F.broadcast(gone) if fits_broadcast(gone) else gone, list(keys), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


class Lake:
    """Named Parquet tables under one root. A rewrite goes to a new folder and the table is then
    pointed at it, so readers and retried tasks never see a half-written table. Tables that are upserted get a bucket for
    about every ``bucket_rows`` rows."""

    def __init__(self, spark: SparkSession, root: str, database: str = "millrace", bucket_rows: int = 50_000):
        self.spark, self.root, self.database, self.bucket_rows = spark, root.rstrip("/"), database, bucket_rows
        spark.sql(f"create database if not exists {database} location '{self.root}/_db'")

    def name(self, table: str) -> str:
        return f"{self.database}.{table.lower()}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def missing(self, tables: Sequence[str]) -> list[str]:
        return [t for t in tables if not self.exists(t)]

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def refresh(self, table: str, df: DataFrame, version: str | None = None,
                partition_by: Sequence[str] = ()) -> None:
        """Replace the whole table. The rows go to a folder of their own first; then one change of the catalog points
        the table there, so a reader finds the old rows or the new ones. Old folders stay for those who still read them.

        Only a table that gets other columns, or is partitioned, has to be dropped and created."""
        path = f"{self.root}/{table.lower()}/{version or uuid.uuid4().hex}"
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)
        self._point(table, path, df, partition_by)

    def _point(self, table: str, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Let the table be the folder ``path``, written from ``df`` or frames like it."""
        if self.bucketed(table).exists():
            self.spark.sql(f"drop view {self.name(table)}")
        elif self.exists(table):
            if not partition_by and not self._partitions(table) and self._same_columns(table, df):
                self.spark.sql(f"alter table {self.name(table)} set location '{path}'")
                self.spark.catalog.refreshTable(self.name(table))
                return
            self.spark.sql(f"drop table {self.name(table)}")  # external: data stays
        self.spark.sql(f"create table {self.name(table)} using parquet options (compression '{CODEC}') location '{path}'")
        if partition_by:
            self.spark.catalog.recoverPartitions(self.name(table))

    def bucketed(self, table: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> BucketedTable:
        return BucketedTable(self.spark, self.name(table), f"{self.root}/{table.lower()}/buckets", keys, buckets)

    def _partitions(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def _same_columns(self, table: str, df: DataFrame) -> bool:
        return [(f.name, f.dataType) for f in self.read(table).schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        if not self.exists(table):
            self.refresh(table, df, "first", partition_by)
            return
        buckets = self.bucketed(table)
        if buckets.exists():
            buckets.append(df.select(*self.read(table).columns))
            return
        (df.select(*self.read(table).columns).write.mode("append").format("parquet")
         .partitionBy(*partition_by).saveAsTable(self.name(table)))

    def append_parts(self, table: str, parts: Iterable[DataFrame]) -> None:
        """Append frames with the same columns, each evaluated and written before the next is asked for. Readers see
        none or all of them."""
        new = not self.exists(table)
        path = f"{self.root}/{table.lower()}/first" if new else scratch_path(self.spark, "parts")
        for n, part in enumerate(parts):
            part.write.mode("append" if n else "overwrite").option("compression", CODEC).parquet(path)
        if new:
            self._point(table, path, part)
        else:
            self.append(table, self.spark.read.schema(part.schema).parquet(path))

    def insert_absent(self, table: str, df: DataFrame, keys: Sequence[str],
                      partition_by: Sequence[str] = (), unique: bool = False) -> LoadResult:
        """First load, or append of the keys not held yet; running it again adds nothing.

        The batch is evaluated once and counted on the way. ``unique`` says that it holds every key once
        and comes from a written table, so that its keys can be read again (validated rows are such)."""
        seen, added = Observation(), Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        fresh = one_per_key(counted, keys) if keys and not unique else counted
        if keys and self.exists(table):
            fresh = not_in_target(fresh, self.read(table), keys, wanted=df if unique else fresh)
        self.append(table, fresh.observe(added, F.count(F.lit(1)).alias("rows")), partition_by)
        return LoadResult(table, seen.get["rows"], added.get["rows"])

    def upsert(self, table: str, df: DataFrame, keys: Sequence[str]) -> None:
        """Insert new keys and overwrite known ones.

        The table is kept in hash buckets of its keys (see :mod:`millrace.operators.buckets`): only the buckets of the
        batch's keys are read and written. A table written otherwise, or with other columns or keys, is
        rewritten as such once."""
        buckets = self.bucketed(table, keys)
        if buckets.exists() and buckets.keys == list(keys) and self._same_columns(table, df.select(*self.read(table).columns)):
            buckets.upsert(one_per_key(df.select(*self.read(table).columns), keys))
            return
        known = self.exists(table)
        after = staged(upsert(df, self.read(table), keys) if known else one_per_key(df, keys), "upserted")
        if known:
            self.spark.sql(f"drop {'view' if buckets.exists() else 'table'} {self.name(table)}")  # the files stay
        self.bucketed(table, keys, min(MOST_BUCKETS, after.count() // self.bucket_rows + 1)).create(after)

    def insert_ignore(self, table: str, df: DataFrame, keys: Sequence[str]) -> LoadResult:
        """Insert new keys and leave known ones as they are."""
        return self.insert_absent(table, df, keys)
