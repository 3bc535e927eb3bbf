"""Tables in hash buckets behind one pointer: a change rewrites the buckets it touches and nothing else.

Every write goes to a folder of its own. A manifest says which folders make up each bucket, and the catalog's view
over these folders is the pointer: one ``create or replace view`` moves all readers from one state to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import staged

BUCKETS = 32
_BUCKET = "_bucket"
_KEYS, _COUNT, _MANIFEST = "millrace.keys", "millrace.buckets", "millrace.manifest"


def bucket_of(columns: Iterable[Column], buckets: int) -> Column:
    """The bucket of a key; the same for a number and its text, so the type a batch comes in does not matter."""
    return F.pmod(F.xxhash64(*[c.cast("string") for c in columns]), F.lit(buckets)).cast("int")


class BucketedTable:
    """``name`` in the catalog, files under ``folder``, rows placed by ``keys``. A table that exists keeps the keys and
    number of buckets it was made with."""

    def __init__(self, spark: SparkSession, name: str, folder: str, keys: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.name, self.folder = spark, name, folder
        made = self.properties()
        self.keys = made[_KEYS].split(",") if _KEYS in made else list(keys)
        self.buckets = int(made.get(_COUNT, buckets))

    def properties(self) -> dict[str, str]:
        try:
            return {r.key: r.value for r in self.spark.sql(f"show tblproperties {self.name}").collect()}
        except AnalysisException as exc:
            if exc.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                raise
            return {}

    def exists(self) -> bool:
        return _MANIFEST in self.properties()

    def folders(self) -> dict[int, list[str]]:
        """The folders of every bucket that has rows."""
        manifest = self.properties().get(_MANIFEST)
        found: dict[int, list[str]] = {}
        if manifest:
            for bucket, version in self.spark.read.parquet(manifest).orderBy("bucket", "version").collect():
                found.setdefault(bucket, []).append(version)
        return found

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, bucket_of([F.col(k) for k in self.keys], self.buckets))

    def _write(self, placed: DataFrame, dealt: bool = False) -> tuple[str, list[int]]:
        """Write rows by bucket; (version, buckets that got rows). ``dealt``: few tasks hold rows of a bucket already."""
        version = uuid.uuid4().hex
        path = f"{self.folder}/version={version}"
        # one or a few files a bucket; a heavy one is split at run time
        rows = placed if dealt else placed.hint("rebalance", _BUCKET)
        rows.write.partitionBy(_BUCKET).parquet(path)
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        number = F.regexp_extract("path", rf"/{_BUCKET}=(\d+)/", 1).try_cast("int")
        return version, sorted(r.b for r in listed.select(number.alias("b")).distinct().collect() if r.b is not None)

    def _point(self, folders: dict[int, list[str]], like: DataFrame) -> None:
        """Move the pointer to ``folders``; ``like`` has the table's columns."""
        stamp = uuid.uuid4().hex
        manifest = f"{self.folder}/manifest={stamp}"
        rows = sorted((b, v) for b, versions in folders.items() for v in versions)
        self.spark.createDataFrame(rows, "bucket int, version string").coalesce(1).write.parquet(manifest)
        paths = [f"version={v}/{_BUCKET}={b}" for b, v in rows]
        columns = [c for c in like.columns if c != _BUCKET]
        if not paths:  # columns must come from a file
            like.select(*columns).limit(0).write.parquet(f"{self.folder}/empty={stamp}")
            paths = [f"empty={stamp}"]
        named = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"create or replace view {self.name} tblproperties ('{_KEYS}' = '{','.join(self.keys)}', '{_COUNT}' = '{self.buckets}', "
            f"'{_MANIFEST}' = '{manifest}') as select {named} from parquet.`{self.folder}/{{{','.join(paths)}}}`")

    def create(self, df: DataFrame) -> None:
        """Replace everything."""
        version, written = self._write(self.placed(df))
        self._point({b: [version] for b in written}, df)

    def rows(self, buckets: Iterable[int]) -> DataFrame | None:
        """Rows of some buckets, without reading the others; None if these have none."""
        folders = self.folders()
        paths = [f"{self.folder}/version={v}/{_BUCKET}={b}" for b in buckets for v in folders.get(b, [])]
        return self.spark.read.schema(self.spark.table(self.name).schema).parquet(*paths) if paths else None

    def replace(self, df: DataFrame, touched: Sequence[int], dealt: bool = False) -> None:
        """``df``, which has a column ``_bucket``, in place of all rows of the buckets ``touched``. ``dealt``: few of its tasks
        hold rows of a bucket, so it is written as it is."""
        version, written = self._write(df, dealt)
        kept = {b: v for b, v in self.folders().items() if b not in set(touched)}
        self._point({**kept, **{b: [version] for b in written}}, df)

    def upsert(self, fresh: DataFrame) -> list[int]:
        """Rows of ``fresh`` (one a key) in place of those with their keys. Only the buckets of these keys are
        read and written; returns them."""
        placed = staged(self.placed(fresh), "fresh")
        touched = sorted(r[0] for r in placed.select(_BUCKET).distinct().collect())
        if touched:
            old = self.rows(touched)
            after = placed
            if old is not None:
                stays = self.placed(old).join(placed.select(*self.keys, _BUCKET), [_BUCKET, *self.keys], "left_anti")
                after = stays.unionByName(placed, allowMissingColumns=True)
            self.replace(after.select(*fresh.columns, _BUCKET), touched)
        return touched

    def append(self, df: DataFrame) -> None:
        """Further rows, in further files of their buckets."""
        version, touched = self._write(self.placed(df))
        folders = self.folders()
        if touched:
            self._point({**folders, **{b: [*folders.get(b, []), version] for b in touched}}, df)
