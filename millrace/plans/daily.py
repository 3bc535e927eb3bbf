"""The daily order of work: lookup files, entity files, dimensions, streams, fact."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contract import ContractBook, FileContract
from millrace.functions.masking import hash_columns
from millrace.operators import quality_report as qr
from millrace.operators import routing, tracking
from millrace.operators.joins import not_in_target
from millrace.operators.ledger import FileLedger
from millrace.operators.loading import Lake
from millrace.operators.validation import check_files, mark_orphans, validate
from millrace.plans import dimensions as d
from millrace.session import staged
from millrace.sources.arrivals import SOURCE, archived
from millrace.sources.files import delivered_name, fingerprint_files, known_files

TRACKING = "file_tracking"
DIMENSIONS = ("customer", "driver", "restaurant", "agent", "reason", "priority", "channel")


@dataclass
class FileOutcome:
    """``SKIPPED``: every file is unchanged since it was loaded. ``ABSENT``: no file came. ``SPENT``: a file
    failed as often as it may and was not loaded."""

    file_name: str
    stage: str  # VALIDATED, FAILED_SCHEMA, FAILED, SKIPPED, ABSENT or SPENT
    error: str | None = None
    path: str | None = None
    required: bool = False

    @property
    def ok(self) -> bool:
        return self.stage in ("VALIDATED", "SKIPPED") or self.stage == "ABSENT" and not self.required


def file_ledger(lake: Lake) -> FileLedger:
    return FileLedger(lake.spark, f"{lake.root}/file_ledger")


def batch_room(lake: Lake, store: str, contract: FileContract) -> routing.WaitingRoom:
    """Orphans of batch files; one room for each contract, as for streams."""
    return routing.WaitingRoom(lake.spark, f"{store}/orphans_batch/table_name={contract.stem}")


def _bronze(store: str, contract: FileContract, run_id: str) -> str:
    return f"{store}/bronze/{contract.stem}/run={run_id}"


def _last_good(lake: Lake, paths: Collection[str], contract: FileContract, store: str) -> list[DataFrame]:
    """Raw rows of files as they were last loaded, from the raw copies: a file that fails now does not take
    its earlier rows out of Silver."""
    wanted = lake.spark.createDataFrame([(p,) for p in paths], "file_path string")
    last = (file_ledger(lake).state().filter(F.col("status") == tracking.SUCCESS).join(wanted, "file_path", "left_semi")
            .groupBy("file_path").agg(F.max_by("pipeline_run_id", F.struct("processed_at", "pipeline_run_id")).alias("run")))
    by_run: dict[str, list[str]] = {}
    for path, run in last.collect():
        by_run.setdefault(run, []).append(path)
    return [lake.spark.read.parquet(_bronze(store, contract, run)).filter(F.col(SOURCE).isin(files)) for run, files in by_run.items()]


def load_batch_files(lake: Lake, paths: Sequence[str], contract: FileContract, store: str, run_id: str,
                     process_date: str, max_retries: int = 3, spent: Collection[str] = ()) -> list[FileOutcome]:
    """All files of one contract as one table: judge each by its columns, validate the rows of all
    together, route, replace Silver. A file that cannot be read or lacks columns fails alone, and the rows it had
    when it was last loaded stay, as do those of ``spent`` files. Rows waiting for a parent are tried again,
    unless the files bring a row with their key."""
    spark = lake.spark
    try:
        rows, problems = archived(spark, paths, contract, _bronze(store, contract, run_id))
        bad = {r.file_path: r for r in problems.collect()}
    except Exception as exc:  # one contract must not stop the others; the caller decides
        return [FileOutcome(contract.file_name, "FAILED", str(exc), p) for p in paths]
    outcomes = [FileOutcome(contract.file_name, bad[p].current_stage, bad[p].error, p) if p in bad
                else FileOutcome(contract.file_name, "VALIDATED", path=p) for p in paths]
    if rows is None:
        return outcomes
    try:
        parts = [rows, *_last_good(lake, {*bad, *spent}, contract, store)]
        raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).drop("_ingested_at", SOURCE)
        checked = validate(raw, contract)
        room = batch_room(lake, store, contract)
        cycle = room.last()
        waiting = room.left_by(cycle) if cycle >= 0 else None
        if waiting is not None and contract.primary_keys:
            checked = staged(checked, "checked")
            again = validate(_as_text(waiting, contract), contract, duplicates=None)
            checked = checked.unionByName(not_in_target(again, checked, contract.primary_keys), allowMissingColumns=True)
        routed = _routed(lake, checked, contract, store, run_id, process_date, max_retries)
        lake.refresh(contract.silver_table, hash_columns(routed.valid, contract.pii_columns))
        room.leave(routed.waiting, cycle + 1)
    except Exception as exc:
        for outcome in outcomes:
            if outcome.stage == "VALIDATED":
                outcome.stage, outcome.error = "FAILED", str(exc)
    return outcomes


def _as_text(waiting: DataFrame, contract: FileContract) -> DataFrame:
    return routing.as_text_like(waiting, {f.name: "string" for f in contract.read_schema().fields})


def _routed(lake: Lake, checked: DataFrame, contract: FileContract, store: str, run_id: str, process_date: str,
            max_retries: int) -> routing.Routed:
    parents = {fk.column: (_parent(lake, fk), fk.ref_column) for fk in contract.foreign_keys}
    routed = routing.route(mark_orphans(checked, parents), contract.stem, run_id, max_retries,
                           f"{store}/staged/{contract.stem}/{run_id}")
    routing.write_quarantine(routed.quarantine, f"{store}/quarantine", contract.stem, process_date, run_id)
    return routed


def retry_batch_orphans(lake: Lake, contract: FileContract, store: str, run_id: str, process_date: str,
                        max_retries: int = 3) -> int:
    """Try the waiting rows of a contract without new files: those whose parents are there now are added to Silver, the
    others wait on or expire. Returns how many were added. Silver has them before the room is replaced, and adds only
    absent keys: a retry that breaks off is repeated without harm."""
    room = batch_room(lake, store, contract)
    cycle = room.last()
    waiting = room.left_by(cycle) if cycle >= 0 else None
    if waiting is None or waiting.isEmpty():
        return 0
    checked = validate(_as_text(waiting, contract), contract, duplicates=None)
    routed = _routed(lake, checked, contract, store, f"{run_id}-retry", process_date, max_retries)
    added = lake.insert_absent(contract.silver_table, hash_columns(routed.valid, contract.pii_columns),
                               contract.primary_keys, unique=True)
    room.leave(routed.waiting, cycle + 1)
    return added.inserted


def _parent(lake: Lake, fk) -> DataFrame:
    """The Silver table a key refers to. Without that table no key of it is known, so there is an empty one:
    every value that is not null waits as an orphan."""
    table = f"silver_{fk.ref_table.rsplit('.', 1)[0].lower()}"
    if lake.exists(table):
        return lake.read(table)
    return lake.spark.createDataFrame([], f"`{fk.ref_column}` string")


def by_dependency(contracts: Sequence[FileContract]) -> list[list[FileContract]]:
    """Contracts in levels: a file comes after the files its foreign keys name."""
    left, levels = list(contracts), []
    while left:
        open_names = {c.file_name for c in left}
        ready = [c for c in left
                 if not any(fk.ref_table in open_names - {c.file_name} for fk in c.foreign_keys)]
        levels.append(ready or left)  # a circle of references is loaded together
        left = [c for c in left if c not in levels[-1]]
    return levels


def load_batch_folder(lake: Lake, folder: str, contracts: Sequence[FileContract], store: str,
                      run_id: str, process_date: str, max_attempts: int = 3,
                      required: Collection[str] = ()) -> list[FileOutcome]:
    """All known files of a folder, one logical table for each contract.

    A contract is loaded when any of its files changed since it was last loaded; then all its files are,
    as Silver is replaced. Else its waiting rows are tried again. Parents are loaded before the files that refer to
    them. The ledger gets an event for each file taken and reported; the tracking view shows one row per file and run. A file that used up its attempts is left out and reported
    as ``SPENT``; contracts named in ``required`` (stems) fail when no file came.
    """
    book = ContractBook(list(contracts))
    ledger = file_ledger(lake)
    files = staged(known_files(fingerprint_files(lake.spark, folder), book), "arrived")
    due = staged(ledger.due(files, max_attempts).select("file_path", "last_hash"), "due")
    spent_paths = {p for paths in _by_stem(ledger.spent(files, max_attempts)).values() for p in paths}
    ledger.take(due, run_id)
    ledger.publish(lake.name(TRACKING))
    arrived = _by_stem(files)
    due_paths = {p for paths in _by_stem(due).values() for p in paths}

    def load(contract: FileContract) -> tuple[list[FileOutcome], int]:
        paths = arrived.get(contract.stem, [])
        worn = [FileOutcome(contract.file_name, "SPENT", "attempts used up", p) for p in paths if p in spent_paths]
        if due_paths & set(paths):
            done = load_batch_files(lake, [p for p in paths if p not in spent_paths], contract, store, run_id, process_date,
                                    spent=[p for p in paths if p in spent_paths])
            loaded = any(o.stage == "VALIDATED" for o in done)
            return done + worn, lake.read(contract.silver_table).count() if loaded else 0
        retry_batch_orphans(lake, contract, store, run_id, process_date)
        if not paths:
            return [FileOutcome(contract.file_name, "ABSENT", required=contract.stem in required)], 0
        return worn or [FileOutcome(contract.file_name, "SKIPPED")], 0

    outcomes, told = [], []
    for level in by_dependency(contracts):
        # files of one level do not refer to each other: their jobs share the cluster
        with ThreadPoolExecutor(max_workers=4) as pool:
            for found, rows in pool.map(load, level):
                outcomes += found
                told += [(o.path, tracking.SUCCESS if o.ok else tracking.FAILED, o.stage, rows, o.error)
                         for o in found if o.path in due_paths]
    if told:
        ledger.report(lake.spark.createDataFrame(
            told, "file_path string, status string, current_stage string, record_count int, error string"), run_id)
    return outcomes


def _by_stem(files: DataFrame) -> dict[str, list[str]]:
    """Paths by contract: one short row per file."""
    found: dict[str, list[str]] = {}
    stem = F.regexp_extract(delivered_name(F.col("file_path")), r"^(.*)\.", 1)
    for path, name in files.select("file_path", stem.alias("stem")).distinct().orderBy("file_path").collect():
        found.setdefault(name, []).append(path)
    return found


def build_dimensions(lake: Lake) -> dict[str, DataFrame]:
    """Type-1 dimensions from Silver; keys given by an earlier version are kept."""
    s = {n: lake.read(f"silver_{n}") for n in (
        "customers", "drivers", "restaurants", "agents", "reasons", "priorities", "channels",
        "regions", "cities", "segments", "categories", "teams", "reason_categories")}

    def known(name: str) -> DataFrame | None:
        return lake.read(f"dim_{name}") if lake.exists(f"dim_{name}") else None

    # personal data was hashed when Silver was loaded
    built = {
        "customer": d.dim_customer(s["customers"], s["regions"], s["cities"], s["segments"],
                                   known("customer"), hashed=True),
        "driver": d.dim_driver(s["drivers"], s["regions"], s["cities"], known("driver"), hashed=True),
        "restaurant": d.dim_restaurant(s["restaurants"], s["categories"], s["regions"], s["cities"],
                                       known("restaurant")),
        "agent": d.dim_agent(s["agents"], s["teams"], known("agent"), hashed=True),
        "reason": d.dim_reason(s["reasons"], s["reason_categories"], known("reason")),
        "priority": d.dim_priority(s["priorities"], known("priority")),
        "channel": d.dim_channel(s["channels"], known("channel")),
    }
    for name, df in built.items():
        natural = f"{name}_id"
        if lake.exists(f"dim_{name}"):
            lake.upsert(f"dim_{name}", df, [natural])
        else:
            lake.refresh(f"dim_{name}", df)
    return dimensions(lake)


def dimensions(lake: Lake) -> dict[str, DataFrame]:
    return {n: lake.read(f"dim_{n}") for n in DIMENSIONS}


def quality_run(sources: dict[str, dict[str, DataFrame]], book: ContractBook, run_id: str,
                root: str) -> DataFrame:
    """Count issues in every file of every partition, write the run's report, return it.

    Files are measured one after the other so that each has its own latency; a measurement is one
    aggregated row, written out so that it is not computed again for the report.
    """
    measured = None
    for files in sources.values():
        for stem, df in files.items():
            contract = book.find(stem)
            if contract is None:
                continue
            began = time.perf_counter()
            issues = staged(qr.column_issues(df, contract), "issues")
            spent = (time.perf_counter() - began) * 1000
            row = qr.per_file_metrics(issues, run_id, elapsed_ms=F.lit(spent))
            measured = row if measured is None else measured.unionByName(row)
    if measured is None:
        raise ValueError("no source file has a contract")
    report = staged(qr.run_snapshot(measured).withColumn(
        "recorded_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")), "report")
    qr.write_report(report, root)
    return report


def run_day(lake: Lake, folders: Sequence[str], book: ContractBook, store: str, run_id: str,
            process_date: str, streams: Callable[[dict[str, DataFrame]], bool] | None = None,
            required: Collection[str] = ()) -> bool:
    """Master folder, then batch folder, then dimensions, then the streams; stops at a failure, also when
    a contract in ``required`` (stems) has no file in any folder."""
    names = [e for c in book.section("batch") if c.stem in required for e in (f"{c.stem}.csv", f"{c.stem}.json")]
    if names:
        arrived = reduce(DataFrame.union, [fingerprint_files(lake.spark, f) for f in folders]).select(F.col("file_path").alias("path"))
        state = check_files(arrived, names).filter(F.col("state") == "found")
        found = {r.file_name.rsplit(".", 1)[0] for r in state.collect()}
        if set(required) - found:
            return False
    for folder in folders:
        outcomes = load_batch_folder(lake, folder, book.section("batch"), store, f"{run_id}-{folder.rsplit('/', 1)[-1]}",
                                     process_date)
        if not all(o.ok for o in outcomes):
            return False
    dims = build_dimensions(lake)
    return streams(dims) if streams else True
