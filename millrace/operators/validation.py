"""Row-level contract validation: every row leaves with a status and its reasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contract import FileContract
from millrace.functions import rules
from millrace.operators.joins import HOT_SHARE, fits_broadcast, flag_members, flag_unless, salted_join, unknown_keys
from millrace.session import ROW, staged

STATUS, REASONS, RETRIES = "_record_status", "_error_reasons", "_retry_count"
VALID, INVALID, ORPHAN = "VALID", "INVALID", "ORPHAN"
CATEGORIES = ("data_type", "not_allowed_nulls", "format", "range", "enum", "duplicated", "orphan")
EXPIRED = "expired_orphan"
NO_REASONS = "cast(map() as map<string,array<string>>)"
HASH_ROWS = 1_000_000  # so many repeated hashes, 8 bytes each, are sent to all executors


# ---- structure ------------------------------------------------------------------------------

@dataclass
class ColumnCheck:
    """Outcome of comparing a file's columns with its contract."""

    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    repeated: list[str] = field(default_factory=list)
    common: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.missing and bool(self.common)


def compare_names(actual: Sequence[str], expected: Sequence[str]) -> ColumnCheck:
    have, want = set(actual), set(expected)
    return ColumnCheck(
        missing=sorted(want - have),
        extra=sorted(have - want),
        repeated=sorted({n for n in actual if list(actual).count(n) > 1}),
        common=sorted(have & want),
    )


def check_columns(df: DataFrame, contract: FileContract) -> ColumnCheck:
    """Missing columns fail a file; extra ones are carried along."""
    return compare_names(df.columns, contract.names)


def check_files(files: DataFrame, expected: Sequence[str], path: str = "path") -> DataFrame:
    """Compare the files that arrived with the contract: ``(file_name, state)`` where state is
    ``found``, ``missing`` or ``unknown``. ``expected`` is the contract's short file list."""
    spark = files.sparkSession
    arrived = (files.select(F.element_at(F.split(path, "/"), -1).alias("file_name")).distinct()
               .withColumn("_here", F.lit(True)))
    wanted = spark.createDataFrame([(n,) for n in expected], "file_name string").withColumn(
        "_wanted", F.lit(True))
    state = (F.when(F.col("_wanted").isNull(), "unknown")
             .when(F.col("_here").isNull(), "missing").otherwise("found"))
    return arrived.join(wanted, "file_name", "full").select("file_name", state.alias("state"))


# ---- duplicates -----------------------------------------------------------------------------

def flag_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                    policy: str = "keep_last", flag: str = "_duplicated", row: str | None = None) -> DataFrame:
    """Mark repeated keys. ``keep_last`` spares the row that ``order_by`` puts last, ``all`` marks
    every copy. Null keys are copies of each other.

    ``df`` is evaluated once and written with a number for every row. First the rows of each key's hash are counted, in
    fixed width; only rows whose hash occurs again are aggregated by key, order and number, combined on the map
    side, so a key may hold any share of the rows. Only repeated keys come out, with the number of the row to spare. While
    hashes and keys are few they are broadcast and no row is shuffled; many hashes are not looked up, all rows are aggregated.

    ``row`` is a column that tells the rows apart, where ``df`` comes from a written table (see ``named_rows``). Then ``df`` is
    not written but evaluated up to three times, first for the keys alone.
    """
    rows = df.withColumn("_row", F.col(row)) if row else staged(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_key", F.struct(*keys))
    hashes = staged(rows.groupBy(F.xxhash64("_key").alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
                    .filter("_n > 1").select("_hash"), "repeated-hashes")
    plain = [f"`{c}`" for c in df.columns]
    if hashes.isEmpty():
        return rows.select(*plain, F.lit(False).alias(flag))
    some = rows
    if fits_broadcast(hashes, HASH_ROWS):
        some = rows.withColumn("_hash", F.xxhash64("_key")).join(F.broadcast(hashes), "_hash", "left_semi")
    spared = F.lit(None).cast(rows.schema["_row"].dataType) if policy == "all" else F.max_by("_row", F.struct(*order_by, "_row"))
    repeated = staged(some.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), spared.alias("_spared"))
                      .filter("_n > 1").withColumn("_again", F.lit(True)), "repeated")
    lost = F.coalesce(F.col("_again"), F.lit(False)) & ~F.col("_row").eqNullSafe(F.col("_spared"))
    marks = repeated.drop("_n")
    if fits_broadcast(marks):
        marked = rows.join(F.broadcast(marks), "_key", "left")
    else:  # the counts say which keys are hot
        hot = repeated.filter(F.col("_n") * HOT_SHARE > rows.count()).select("_key")
        marked = salted_join(rows, marks, ["_key"], hot=hot)
    return marked.select(*plain, lost.alias(flag))


# ---- row rules ------------------------------------------------------------------------------

def _reason_map(checks: Mapping[str, Sequence[tuple[str, Column]]]) -> Column:
    """``map<category, array<column>>`` holding only the categories that failed.

    Built from conditionals over constant arrays, so it stays inside generated code.
    """
    none = F.expr("cast(array() as array<string>)")
    found = []
    for category in CATEGORIES:
        hits = checks.get(category)
        if hits:
            columns = F.concat(*[F.when(bad, F.array(F.lit(n))).otherwise(none) for n, bad in hits])
            some = F.lit(False)
            for _, bad in hits:
                some = some | bad
            found.append(F.when(some, F.create_map(F.lit(category), columns))
                         .otherwise(F.expr(NO_REASONS)))
    return F.map_concat(*found)


def validate(df: DataFrame, contract: FileContract, *, bounds: str = "exclusive",
             check_enum: bool = True, duplicates: str | None = "keep_last",
             order_by: Sequence[str] | None = None,
             extra_types: Mapping[str, str] | None = None) -> DataFrame:
    """Cast ``df`` to its contract and add status, reasons and retry count.

    Rules of one row are Column expressions in a single projection; only the key rule needs a
    shuffle (``duplicates=None`` leaves it out). Columns beyond the contract are kept;
    ``extra_types`` casts those the caller knows. Rows named by ``named_rows`` are not written for the key rule; the names go.
    """
    outcome = check_columns(df, contract)
    if not outcome.ok:
        raise ValueError(f"{contract.file_name}: missing columns {outcome.missing}")
    have = {f.name: f.dataType for f in df.schema.fields}

    def raw(name: str) -> Column:
        c = F.col(name)
        return rules.null_tokens(c) if isinstance(have[name], T.StringType) else c

    typed = {n: rules.typed(raw(n), have[n], t) for n, t in contract.types.items()}
    extras = {n: rules.typed(raw(n), have[n], t)
              for n, t in (extra_types or {}).items() if n in have and n not in typed}
    formats, ranges, enums = contract.formats, contract.ranges, contract.enums

    checks: dict[str, list[tuple[str, Column]]] = {c: [] for c in CATEGORIES}
    for name, kind in contract.types.items():
        value = F.col(name)
        if kind != "varchar":
            checks["data_type"].append((name, F.col(f"_raw_{name}").isNotNull() & value.isNull()))
        if name in contract.not_null:
            source = F.col(f"_raw_{name}") if kind != "varchar" else value
            checks["not_allowed_nulls"].append((name, source.isNull()))
        if formats.get(name) in rules.ROW_FORMATS:
            checks["format"].append((name, rules.bad_format(value, rules.ROW_FORMATS[formats[name]])))
        if name in ranges:
            checks["range"].append((name, rules.bad_range(value, *ranges[name], bounds)))
        if check_enum and name in enums:
            checks["enum"].append((name, rules.bad_enum(value, enums[name])))

    others = [n for n in df.columns if n not in typed and n not in extras]
    shown = df.select(
        *[c.alias(n) for n, c in {**typed, **extras}.items()], *others,
        *[raw(n).alias(f"_raw_{n}") for n, t in contract.types.items() if t != "varchar"],
    )
    if duplicates and contract.primary_keys:
        names = order_by or [n for n in ("updated_at",) if n in typed]
        # the contract's columns decide first; what else tells two rows apart makes the choice repeatable
        rest = [n for n, t in shown.dtypes if n not in typed and n != ROW and not t.startswith("map")]
        order = [F.col(n) for n in [*names, *[n for n in typed if n not in names], *rest]]
        shown = flag_duplicates(shown, contract.primary_keys, order, duplicates, row=ROW if ROW in df.columns else None)
        checks["duplicated"] = [(k, F.col("_duplicated")) for k in contract.primary_keys]

    failed = F.lit(False)
    for hits in checks.values():
        for _, bad in hits:
            failed = failed | bad
    carried = [n for n in others if n not in (STATUS, REASONS, RETRIES, ROW)]
    retries = F.col(RETRIES) if RETRIES in df.columns else F.lit(0)
    # the map is only built for failing rows
    return shown.select(
        *contract.names, *extras, *carried,
        F.when(failed, INVALID).otherwise(VALID).alias(STATUS),
        F.when(failed, _reason_map(checks)).otherwise(F.expr(NO_REASONS)).alias(REASONS),
        retries.cast("int").alias(RETRIES),
    )


def mark_orphans(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]],
                 null_fk: str = "pass", keys_first: bool = False) -> DataFrame:
    """Give VALID rows whose foreign key has no parent the status ORPHAN.

    ``parents`` maps a foreign-key column to (parent table, parent key). A null key passes unless
    ``null_fk="orphan"``. Invalid rows stay invalid. ``keys_first`` is for a ``df`` that comes from a written table: the keys
    without a parent are found on the keys alone and written, so the outcome is settled and ``df`` may be evaluated again.
    """
    out, lost = df, []
    for column, (parent, ref) in parents.items():
        flag = f"_known_{column}"
        out = (flag_unless(out, unknown_keys(df, parent, column, ref), column, flag) if keys_first
               else flag_members(out, parent, column, ref, flag))
        unknown = ~F.col(flag)
        if null_fk == "pass":
            unknown = unknown & F.col(column).isNotNull()
        lost.append((column, unknown))
    if not lost:
        return df
    any_lost = F.lit(False)
    for _, unknown in lost:
        any_lost = any_lost | unknown
    hit = (F.col(STATUS) == VALID) & any_lost
    reasons = F.map_concat(REASONS, _reason_map({"orphan": lost}))
    return out.withColumns({
        STATUS: F.when(hit, ORPHAN).otherwise(F.col(STATUS)),
        REASONS: F.when(hit, reasons).otherwise(F.col(REASONS)),
    }).select(*df.columns)


def valid_keys(df: DataFrame, contract: FileContract) -> DataFrame:
    """Keys of the valid rows: the lookup for later foreign-key checks."""
    return df.filter(F.col(STATUS) == VALID).select(*contract.primary_keys)


def reasons_text(c: str = REASONS) -> Column:
    """Reasons as sorted ``category:column`` text, for reports and comparisons."""
    parts = []
    for category in sorted((*CATEGORIES, EXPIRED)):
        columns = F.array_sort(F.col(c)[category])
        parts.append(F.concat(F.lit(f"{category}:"), F.array_join(columns, f",{category}:")))
    return F.concat_ws(",", *parts)
