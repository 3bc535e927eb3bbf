"""Registered queries: events rendered as log lines, parsed and questioned."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.logtext import file_result, parse_lines, partition_name
from millrace.plans import logs
from millrace.session import scratch_path
from millrace.sources.reports import read_json_lines, read_logs
from millrace.workload import model as m


def log_text(spark, sf):
    """One line per event; clicks with small values lack the logger and are not log lines."""
    kind = F.col("event_type")
    level = (F.when(kind == "error", "error").when(kind == "purchase", "WARNING")
             .when(kind == "view", "TRACE").when(kind == "click", "DEBUG").otherwise("INFO"))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    name = F.when((kind == "click") & (F.col("value") < 20), F.concat(F.lit("user"), F.col("user_id").cast("string"))
                  ).otherwise(F.concat(F.lit("[App."), kind, F.lit("]")))
    text = F.when(kind == "purchase", F.concat(F.lit("→ ISSUES="), F.col("user_id").cast("string"),
                                               F.lit(" rows="), cents, F.lit(" null=0 [12.5ms]"))
                  ).when(kind == "signup", F.concat(F.lit("→ CLEAN  rows="), cents, F.lit(" [3ms]"))
                         ).when(kind == "view", F.concat(F.lit("Partition: user/"), F.col("user_id").cast("string"),
                                                         F.lit(" (1 file)"))
                                ).otherwise(F.concat(F.lit("Value "), cents))
    return m.table(spark, sf, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("  "), level, F.lit("   "), name,
                 F.lit("  "), text, F.lit("  ")).alias("value"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("source_file"))


TEXT_SQL = """
lines as (
    select strftime(ts, '%Y-%m-%dT%H:%M:%S') || '  ' ||
           case event_type when 'error' then 'error' when 'purchase' then 'WARNING' when 'view' then 'TRACE'
                when 'click' then 'DEBUG' else 'INFO' end || '   ' ||
           case when event_type = 'click' and value < 20 then 'user' || user_id
                else '[App.' || event_type || ']' end || '  ' ||
           case event_type when 'purchase' then '→ ISSUES=' || user_id || ' rows='
                    || cast(round(value * 100) as bigint) || ' null=0 [12.5ms]'
                when 'signup' then '→ CLEAN  rows=' || cast(round(value * 100) as bigint) || ' [3ms]'
                when 'view' then 'Partition: user/' || user_id || ' (1 file)'
                else 'Value ' || cast(round(value * 100) as bigint) end || '  ' as value,
           'user-' || user_id as source_file
    from events
),
hit as (
    select regexp_extract(rtrim(value), '^(\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2})\\s{2}(\\w+)\\s+\\[([^\\]]+)\\]\\s+(.+)$',
                          ['ts', 'level', 'logger', 'message']) as p, source_file
    from lines
),
log as (
    select cast(p.ts as timestamp) as timestamp, upper(p.level) as level, p.logger as logger,
           trim(p.message) as message,
           cast(case upper(p.level) when 'DEBUG' then 0 when 'WARNING' then 2 when 'WARN' then 2
                when 'ERROR' then 3 when 'CRITICAL' then 4 else 1 end as tinyint) as level_rank, source_file
    from hit where p.ts <> ''
)""".replace("\\\\", "\\")


def parsed(spark, sf):
    return parse_lines(log_text(spark, sf))


def log_files(spark, sf):
    """Lines written to text files, every line scanned back, counted by level."""
    path = scratch_path(spark, "logs")
    log_text(spark, sf).select("value").write.text(path)
    return logs.count_by_level(read_logs(spark, path, glob="part-*"))


def log_filter(spark, sf):
    return logs.filter_logs(parsed(spark, sf), "warning", logger="app.ERR", message="value 1")


def log_page(spark, sf):
    """The newest 200 lines at INFO or above."""
    return logs.filter_logs(parsed(spark, sf), "INFO", last_n=200).select(
        "timestamp", "level", "logger", "message", "source_file")


def log_results(spark, sf):
    rows = parsed(spark, sf)
    result = file_result(F.col("message"))
    return (rows.select(*[c.alias(n) for n, c in result.items()],
                        partition_name(F.col("message")).alias("partition"))
            .filter("rows is not null or partition <> ''"))


LOG_RESULTS_SQL = "with " + TEXT_SQL + r"""
select case when message like '→%' then message like '→ CLEAN%' end as is_clean,
       case when message like '→%' then coalesce(try_cast(regexp_extract(message, 'ISSUES=(\d+)', 1) as bigint), 0)
       end as issue_count,
       try_cast(nullif(regexp_extract(message, 'rows=(\d+)', 1), '') as bigint) as rows,
       try_cast(nullif(regexp_extract(message, '\[([\d.]+)ms\]', 1), '') as double) as elapsed_ms,
       regexp_extract(message, 'Partition: (\S+)', 1) as partition
from log where message like '→%' or message like 'Partition:%'"""


def event_timeline(spark, sf):
    return logs.timeline(m.table(spark, sf, "events"), "ts")


TIMELINE_SQL = """
with counts as (select date_trunc('minute', ts) as minute, count(*) as count from events group by 1),
spine as (select unnest(generate_series(min(minute), max(minute), interval 1 minute)) as minute from counts)
select s.minute, coalesce(c.count, 0) as count from spine s left join counts c on s.minute = c.minute"""


def log_export(spark, sf):
    """Filtered lines exported as CSV and read back."""
    path = scratch_path(spark, "export")
    logs.export_csv(logs.filter_logs(parsed(spark, sf), "ERROR"), path)
    return spark.read.option("header", True).csv(path).select("level", "logger", "message", "source_file")


def json_lines(spark, sf):
    """The JSON in the events table written as lines and scanned back with a schema."""
    path = scratch_path(spark, "props")
    m.table(spark, sf, "events").select("props").write.text(path)
    back = read_json_lines(spark, path, T.StructType([T.StructField("k", T.LongType())]), glob="*")
    return back.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))


QUERIES: dict[str, tuple[m.Query, str | None]] = {
    "log_parse": (parsed, "with " + TEXT_SQL + " select * from log"),
    "log_filter": (
        log_filter, "with " + TEXT_SQL + """ select * from log where level_rank >= 2
            and logger ilike '%app.err%' and message ilike '%value 1%'"""),
    "log_page": (
        log_page, "with " + TEXT_SQL + """ select timestamp, level, logger, message, source_file from log
            where level_rank >= 1 order by timestamp desc, level, logger, message, source_file limit 200"""),
    "log_levels": (
        lambda s, d: logs.count_by_level(parsed(s, d)),
        "with " + TEXT_SQL + " select level, count(*) as count from log group by level"),
    "log_files": (log_files, "with " + TEXT_SQL + " select level, count(*) as count from log group by level"),
    "log_results": (log_results, LOG_RESULTS_SQL),
    "log_export": (
        log_export, "with " + TEXT_SQL + """ select level, logger, message, source_file from log
            where level_rank >= 3"""),
    "event_timeline": (event_timeline, TIMELINE_SQL),
    "json_lines": (
        json_lines,
        """select cast(json_extract(props, '$.k') as bigint) as k, count(*) as rows from events group by 1"""),
}
