"""Single-figure KPIs over the ticket fact and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import percent, ratio
from millrace.operators.joins import lookup_join

RESPONSE_LIMIT_MIN, RESOLUTION_LIMIT_MIN = 1, 15

def total_tickets(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("ticket_id").alias("total_tickets"))


def breach_rate(fact: DataFrame, response: float = RESPONSE_LIMIT_MIN,
                resolution: float = RESOLUTION_LIMIT_MIN) -> DataFrame:
    late = (F.col("first_response_time_min") > response) | (F.col("resolution_time_min") > resolution)
    return fact.agg(percent(F.count_if(late), F.count(F.lit(1))).alias("sla_breach_rate_pct"))


def average_times(fact: DataFrame) -> DataFrame:
    def mean(c: str):
        return ratio(F.sum(c), F.count(c))

    return fact.agg(mean("resolution_time_min").alias("avg_resolution_time_mins"),
                    mean("first_response_time_min").alias("avg_first_response_time_mins"))


def reopen_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(percent(F.count_if("is_reopened"), F.count(F.lit(1))).alias("reopen_rate_pct"))


def revenue_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("refund_amount").alias("total_refund_amount"),
                    F.sum("total_revenue_impact").alias("total_revenue_impact"))


def tickets_by(fact: DataFrame, dims: list[tuple[DataFrame, str]], group: list[str]) -> DataFrame:
    """Tickets counted per dimension attribute, most first. Each dimension joins on its key; the
    fact is counted per key before the join, so only key counts travel."""
    first_dim, key = dims[0]
    out = fact.groupBy(key).agg(F.count("ticket_id").alias("total_tickets"))
    for dim, on in dims:
        out = lookup_join(out, dim, on, "inner")
    return (out.groupBy(*group).agg(F.sum("total_tickets").alias("total_tickets"))
            .orderBy(F.col("total_tickets").desc_nulls_last(), *group))


def records_processed(runs: DataFrame) -> DataFrame:
    return runs.agg(F.sum("total_rows").alias("total_records_processed"))


def issue_rates(per_file: DataFrame) -> DataFrame:
    rows = F.sum("total_rows")
    return per_file.agg(*[percent(F.sum(f"{c}_issues"), rows).alias(f"{c}_issue_rate_pct")
                          for c in ("null", "enum", "format", "type", "range")])


def quarantine_totals(per_file: DataFrame) -> DataFrame:
    return per_file.agg(F.sum("issue_count").alias("total_quarantined_records"),
                        F.sum("missing_cols").alias("total_missing_column_incidents"))


def file_success(per_file: DataFrame) -> DataFrame:
    return per_file.agg(
        percent(F.count_if("is_clean"), F.count(F.lit(1))).alias("file_processing_success_rate_pct"),
        F.round(F.avg("elapsed_ms"), 2).alias("avg_processing_latency_ms"))
