"""Micro-batch ingestion: files found by the streaming source go through validation, routing and
an idempotent load; the ticket fact and the views follow.

Exactly-once comes from two sides: the checkpoint hands every file to one batch number, and every
write of a batch is either keyed by that number or an insert of keys not held yet. A batch that is
run again after a failure therefore changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatch, translate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.contract import FileContract
from millrace.functions.masking import hash_columns
from millrace.operators import routing, tracking
from millrace.operators.joins import BROADCAST_ROWS, fits_broadcast, only_for
from millrace.operators.keys import number_by_key, number_rows
from millrace.operators.ledger import FileLedger
from millrace.operators.loading import Lake
from millrace.operators.validation import mark_orphans, validate
from millrace.sources.arrivals import SOURCE, archived, arriving_files
from millrace.sources.files import archive_raw
from millrace.plans import fact as facts
from millrace.plans import revenue, sla
from millrace.session import CODEC, named_rows, shuffles_removed, staged


def without_repeats(source: DataFrame, columns: Sequence[str], within: str) -> DataFrame:
    """A stream without rows that equal an earlier one in ``columns`` and arrived at most ``within`` after it.

    Digests of the rows are kept in the state store, spread over all tasks, for that time and no longer, so
    repeats are found without reading the target. Time is that of arrival: no row is ever late. Rows with
    the same key and other values pass; the load decides between them."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}), 256)
    return (source.withColumns({"_repeat": digest, "_seen_at": F.current_timestamp()}).withWatermark("_seen_at", within)
            .dropDuplicatesWithinWatermark(["_repeat"]).drop("_repeat", "_seen_at"))


@dataclass
class StreamLoader:
    """Loads one stream file into its Silver table, batch by batch.

    ``parents`` maps a foreign-key column to (table name, parent key); tables are looked up when a
    batch runs, so parents that arrive late are seen by the next retry. ``repeats_within`` (``"2 days"``) drops rows
    that came before within that time, see :func:`without_repeats`.
    """

    lake: Lake
    contract: FileContract
    store: str
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    extra_types: Mapping[str, str] = field(default_factory=dict)
    max_retries: int = 3
    bounds: str = "exclusive"
    process_date: str = "stream"
    partition_by: Sequence[str] = ()
    repeats_within: str | None = None

    @property
    def table(self) -> str:
        return self.contract.silver_table

    def _known_parents(self) -> dict[str, tuple[DataFrame, str]]:
        """Parent keys; a table that is not there yet knows none, so rows that name one wait for it."""
        nobody = lambda k: self.lake.spark.createDataFrame([], f"`{k}` string")
        return {c: (self.lake.read(t) if self.lake.exists(t) else nobody(k), k) for c, (t, k) in self.parents.items()}

    @property
    def room(self) -> routing.WaitingRoom:
        return routing.WaitingRoom(self.lake.spark, f"{self.store}/orphans/{self.contract.stem}")

    def last_cycle(self) -> int:
        """The latest batch that left a waiting room, -1 before the first."""
        return self.room.last()

    def waiting_at(self, batch_id: int) -> DataFrame | None:
        """Orphans left by an earlier batch, ready to be tried again."""
        return self.room.left_by(batch_id) if batch_id >= 0 else None

    def bronze(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Archive the raw batch and read it back.

        The steps that follow scan the batch several times: from Parquet instead of the text files,
        and in the lake's own session, where plans adapt at run time (a streaming batch's session
        does not).
        """
        path = f"{self.store}/bronze/{self.contract.stem}/batch={batch_id}"
        if "date" in batch.columns and "hour" in batch.columns:
            archive_raw(batch, path, "overwrite")
        else:
            stamped = batch.withColumn("_ingested_at", F.current_timestamp())
            stamped.write.mode("overwrite").option("compression", CODEC).parquet(path)
        stored = T.StructType([*batch.schema.fields, T.StructField("_ingested_at", T.TimestampType())])
        return self.lake.spark.read.schema(stored).parquet(path)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Body of ``foreachBatch``."""
        raw = named_rows(self.bronze(batch, batch_id)).drop("_ingested_at")
        waiting = self.waiting_at(batch_id - 1)
        if waiting is not None:
            raw = raw.unionByName(routing.as_text_like(named_rows(waiting), dict(raw.dtypes)), allowMissingColumns=True)
        self._load(raw, f"batch-{batch_id}", batch_id)

    def retry(self) -> bool:
        """Try the waiting rows again without new files; True if there were any.

        The room of the latest batch is replaced by what still waits, so the next batch goes on from there. A
        retry has a name of its own and never touches a batch's folders. Rows reach Silver before the room
        is replaced: a retry that breaks off is repeated without harm."""
        last = self.last_cycle()
        waiting = self.waiting_at(last)
        if waiting is None or waiting.isEmpty():
            return False
        kept = staged(waiting, "waiting")
        text = {f.name: f.dataType.simpleString() for f in self.contract.read_schema(self.extra_types).fields}
        raw = routing.as_text_like(named_rows(kept), text)
        self._load(raw, f"retry-{last}-{uuid.uuid4().hex[:8]}", last)
        return True

    def _load(self, raw: DataFrame, run_id: str, cycle: int) -> None:
        """``raw`` is a written table with named rows. It is evaluated again where that saves a copy of it: valid rows are
        written once, to Silver. Which keys repeat or have no parent is written down, so every evaluation has the same outcome."""
        stem = self.contract.stem
        with shuffles_removed(self.lake.spark):
            checked = validate(raw, self.contract, bounds=self.bounds, extra_types=self.extra_types)
            marked = mark_orphans(checked, self._known_parents(), keys_first=True)
            routed = routing.route(marked, stem, run_id, self.max_retries,
                                   f"{self.store}/staged/{stem}/{run_id}", stage_valid=False)
            routing.write_quarantine(routed.quarantine, f"{self.store}/quarantine", stem,
                                     self.process_date, run_id)
            clean = hash_columns(routed.valid, self.contract.pii_columns)
            self.lake.insert_absent(self.table, clean.drop("date", "hour"), self.contract.primary_keys,
                                    self.partition_by, unique=True)
            routing.write_waiting(routed.waiting, f"{self.store}/orphans", stem, cycle)

    def start(self, source: DataFrame, every: str | None = None) -> StreamingQuery:
        """Run until the files on hand are read, or keep polling at an interval (``"1 hour"``)."""
        if self.repeats_within:
            source = without_repeats(source, [c for c in (*self.contract.names, *self.extra_types)], self.repeats_within)
        writer = (source.writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", f"{self.store}/checkpoints/{self.contract.stem}"))
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


@dataclass
class FileLoader(StreamLoader):
    """Loads a stream of files (see :meth:`arriving`) file by file: a bad one fails alone.

    Every file is entered in a ledger before and after. One that was loaded with the same content is not loaded
    again, whoever delivers it. One that failed comes again with the next batch or tick until its attempts are used up.
    """

    max_attempts: int = 3
    pattern: str = ""  # of file paths, by default the contract's name with any ending

    def mine(self, path: str) -> bool:
        return fnmatch(path, self.paths)

    @property
    def paths(self) -> str:
        return f"*/{self.pattern or self.contract.stem + '.*'}"

    @property
    def ledger(self) -> FileLedger:
        return FileLedger(self.lake.spark, f"{self.store}/ledger")

    def arriving(self, root: str, layout: str = "*/*", max_files: int = 10_000) -> DataFrame:
        return arriving_files(self.lake.spark, root, self.paths.rsplit("/", 1)[-1], layout, max_files)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Body of ``foreachBatch`` over :meth:`arriving`."""
        files = [tuple(r) for r in batch.select("file_path", "last_hash").collect()]
        self.load_files(files, f"batch-{batch_id}", batch_id)

    def load_files(self, files: Sequence[tuple[str, str]], run_id: str, cycle: int) -> bool:
        """Load ``files`` (path and hash; a batch's, which the source bounds) and those that failed before, with the waiting
        rows; True if Silver may have changed. A batch that runs again takes only what it had not finished."""
        spark, stem, ledger = self.lake.spark, self.contract.stem, self.ledger
        files = spark.createDataFrame(files, "file_path string, last_hash string")
        failed = ledger.failed(translate(self.paths), self.max_attempts)
        wanted = files.unionByName(failed.join(files, "file_path", "left_anti"))
        due = staged(ledger.due(wanted, self.max_attempts).select("file_path", "last_hash"), "due")
        paths = [r.file_path for r in due.collect()]
        if not paths:
            return self.retry()
        ledger.take(due, f"{stem}-{run_id}")
        rows, problems = archived(spark, paths, self.contract, f"{self.store}/bronze/{stem}/batch={cycle}",
                                  [*self.contract.names, *self.extra_types])
        changed = False
        if rows is not None:
            raw = named_rows(rows).drop("_ingested_at", SOURCE)
            waiting = self.waiting_at(self.room.last(before=cycle))
            if waiting is not None:
                raw = raw.unionByName(routing.as_text_like(named_rows(waiting), dict(raw.dtypes)), allowMissingColumns=True)
            self._load(raw, run_id, cycle)
            changed = True
        else:
            changed = self.retry()
        counts = rows.groupBy(F.col(SOURCE).alias("file_path")).agg(F.count(F.lit(1)).alias("record_count")) if rows is not None else None
        told = due.select("file_path").join(F.broadcast(problems), "file_path", "left")
        told = told.join(counts, "file_path", "left") if counts is not None else told.withColumn("record_count", F.lit(0))
        ledger.report(told.select(
            "file_path", F.when(F.col("current_stage").isNull(), tracking.SUCCESS).otherwise(tracking.FAILED).alias("status"),
            F.coalesce("current_stage", F.lit("VALIDATED")).alias("current_stage"),
            F.coalesce("record_count", F.lit(0)).alias("record_count"), "error"), f"{stem}-{run_id}")
        return changed


@dataclass
class CycleJob:
    """One streaming query that does the whole cycle with every batch: all files in write order, rows that wait,
    then fact and views. ``dims`` gives the dimensions when it is called."""

    lake: Lake
    loaders: Sequence[FileLoader]
    store: str
    dims: Callable[[], Mapping[str, DataFrame]] | None = None

    def step(self, batch: DataFrame, batch_id: int) -> None:
        """Body of ``foreachBatch``; a batch without files is a tick that tries what waits and what failed."""
        files = [tuple(r) for r in batch.filter("file_path is not null").select("file_path", "last_hash").collect()]
        changed = False
        for loader in sorted(self.loaders, key=lambda x: x.contract.write_priority):
            mine = [f for f in files if loader.mine(f[0])]
            changed = loader.load_files(mine, f"cycle-{batch_id}", batch_id) or changed
        if changed:
            dims = self.dims() if self.dims else None
            if update_fact(self.lake, f"cycle-{batch_id}", dims) and dims is not None:
                refresh_views(self.lake, dims)

    def start(self, root: str, every: str | None = None, layout: str = "*/*", max_files: int = 10_000) -> StreamingQuery:
        """Run until the files on hand are loaded, or keep on at an interval (``"1 hour"``). Then ticks of
        a rate source start a cycle also where no file came."""
        spark = self.lake.spark
        names = ",".join(sorted({x.paths.rsplit("/", 1)[-1] for x in self.loaders}))
        source = arriving_files(spark, root, f"{{{names}}}", layout, max_files).select("file_path", "last_hash")
        nothing = F.lit(None).cast("string")
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
            nothing.alias("file_path"), nothing.alias("last_hash"))
        writer = source.unionByName(ticks).writeStream.foreachBatch(self.step).option(
            "checkpointLocation", f"{self.store}/checkpoints/cycle")
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


FACT, FACT_PARTS = "fact_ticket_lifecycle", 4


def update_fact(lake: Lake, batch_id: str, dims: Mapping[str, DataFrame] | None = None, max_rows: int = BROADCAST_ROWS) -> bool:
    """Append the tickets the fact does not hold yet. False when a Silver table is missing.

    Mostly a cycle brings few new tickets (at most ``max_rows``) to large tables: orders and events are cut down to the new
    tickets' rows before they are aggregated and joined. Many are built in parts, see :func:`fact_in_parts`.
    """
    if lake.missing(facts.REQUIRED_TABLES):
        return False
    with shuffles_removed(lake.spark):
        existing = lake.read(FACT) if lake.exists(FACT) else None
        tickets = facts.absent_tickets(lake.read("silver_tickets"), existing)
        if fits_broadcast(tickets.select("ticket_id", "order_id"), max_rows):
            tickets = number_by_key(tickets, "ticket_id", "ticket_sk", facts.keys_in_use(existing))
            events = only_for(lake.read("silver_ticket_events"), tickets, "ticket_id")
            orders = only_for(lake.read("silver_orders"), tickets, "order_id")
            rows = facts.fact_rows(tickets, orders, sla.ticket_activity(events), batch_id)
            lake.append(FACT, facts.to_fact_schema(facts.resolve_keys(rows, dims or {})))
        else:
            lake.append_parts(FACT, fact_in_parts(lake, tickets, facts.keys_in_use(existing), batch_id, dims or {}))
    return True


def fact_in_parts(lake: Lake, tickets: DataFrame, base: DataFrame | int, batch_id: str, dims: Mapping[str, DataFrame],
                  parts: int = FACT_PARTS) -> Iterator[DataFrame]:
    """The fact of many new tickets as frames to be written one after the other.

    Tickets meet their orders and dimensions once and are written. Then one part of the tickets after the other, by hash, meets
    its activity, so that the shuffle of one part is on disk at a time. Events are aggregated before they are joined: a hot
    ticket is combined on the map side, and with many tickets a join to cut the events down would shuffle all of them.
    """
    ordered = facts.with_orders(tickets, lake.read("silver_orders"))
    known = facts.resolve_keys(ordered, dims) if dims else ordered
    sks = [sk for _, sk in facts.DIMENSION_KEYS.values() if sk in known.columns]
    ordered = staged(known.select(*facts.TICKET, *facts.BOUGHT, *sks), "ordered-tickets", CODEC)
    numbers = number_rows(ordered.select("ticket_id"), "ticket_id", "ticket_sk", base)
    events = lake.read("silver_ticket_events")
    if events.schema["ticket_id"].dataType != ordered.schema["ticket_id"].dataType:
        parts = 1  # equal ids would have other hashes
    for part in range(parts):
        ours = F.pmod(F.xxhash64("ticket_id"), F.lit(parts)) == part
        activity = sla.ticket_activity(events.filter(ours))
        rows = facts.fact_rows(ordered.filter(ours).join(numbers.filter(ours), "ticket_id"), None, activity, batch_id, keep=sks)
        yield facts.to_fact_schema(rows)


def analytic_views(lake: Lake, dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Per-ticket SLA, dashboard and revenue impact over the lake's tables."""
    activity = sla.ticket_activity(lake.read("silver_ticket_events"))
    timing = sla.ticket_timing(lake.read("silver_tickets"), activity)
    fact = lake.read("fact_ticket_lifecycle")
    metrics = sla.sla_metrics(sla.with_fact(timing, fact), dims)
    return {
        "view_sla_metrics": metrics,
        "view_sla_dashboard": sla.sla_dashboard(metrics),
        "view_revenue_impact": revenue.revenue_impact(fact, dims),
    }


def refresh_views(lake: Lake, dims: Mapping[str, DataFrame]) -> list[str]:
    """(Re)create the views; returns their names."""
    views = analytic_views(lake, dims)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def empty_views(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Views that are missing or hold no rows."""
    return [n for n in names if not spark.catalog.tableExists(n) or spark.table(n).isEmpty()]


def materialize_dashboard(lake: Lake, board: DataFrame, table: str = "mv_sla_dashboard_daily") -> None:
    lake.refresh(table, board.withColumn("materialized_at", F.current_timestamp()))


def run_cycle(loaders: Sequence[tuple[StreamLoader, DataFrame]], lake: Lake, cycle_id: str,
              dims: Mapping[str, DataFrame] | None = None) -> bool:
    """One pass over all streams in write order, then the fact and the views. A stream without new files
    tries its waiting rows again."""
    for loader, source in sorted(loaders, key=lambda pair: pair[0].contract.write_priority):
        before = loader.last_cycle()
        loader.start(source).awaitTermination()
        if loader.last_cycle() == before:
            loader.retry()
    done = update_fact(lake, cycle_id, dims)
    if done and dims is not None:
        refresh_views(lake, dims)
    return done
