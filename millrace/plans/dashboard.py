"""The SLA dashboard kept up to date from changed tickets.

Per-group partials (counts, sums, extremes) are kept for each bucket of tickets. A bucket's partials are built anew when one
of its tickets changes, so extremes and corrections need no undoing, and a ticket is in one bucket, so distinct
counts of buckets add up. The dashboard merges the partials of all buckets; no ticket is read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import money_or_zero, percent, ratio
from millrace.operators.buckets import BUCKETS, BucketedTable, bucket_of
from millrace.operators.loading import Lake

GROUPS = ["restaurant_city", "restaurant_name", "driver_city"]
_SUMS = ("tickets", "rows", "breached", "first_breached", "resolution_breached", "reopened", "first_time", "first_times",
         "resolution_time", "resolution_times", "refunds", "impact")
# what the dashboard reads of the metrics
COLUMNS = ("ticket_id", *GROUPS, "first_response_breached", "resolution_breached", "is_reopened", "first_response_time",
           "resolution_time", "refund_amount", "total_revenue_impact")
PARTS = 4  # tasks, and files, that share a bucket's tickets


def ticket_bucket(ticket: Column, buckets: int = BUCKETS) -> Column:
    return bucket_of([ticket], buckets)


def partials(metrics: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Mergeable measures of every group in every bucket of tickets, for tickets with known cities.

    Rows are dealt once, by ticket, so that tickets are told apart and groups summed in place; a group has a row for each part
    of a bucket that holds some of its tickets."""
    known = metrics.filter((F.col("restaurant_city") != "UNKNOWN") & (F.col("driver_city") != "UNKNOWN"))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("ticket_id").cast("string")), F.lit(PARTS)).cast("int")
    dealt = known.select(ticket_bucket(F.col("ticket_id"), buckets).alias("_bucket"), part.alias("_part"),
                         *COLUMNS).repartition("_bucket", "_part")
    return dealt.groupBy("_bucket", "_part", *GROUPS).agg(
        F.count_distinct("ticket_id").alias("tickets"), F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("first_response_breached") | F.col("resolution_breached")).alias("breached"),
        F.count_if("first_response_breached").alias("first_breached"),
        F.count_if("resolution_breached").alias("resolution_breached"), F.count_if("is_reopened").alias("reopened"),
        F.sum("first_response_time").alias("first_time"), F.count("first_response_time").alias("first_times"),
        F.sum("resolution_time").alias("resolution_time"), F.count("resolution_time").alias("resolution_times"),
        F.max("resolution_time").alias("longest"), F.min("resolution_time").alias("shortest"),
        F.sum(money_or_zero(F.col("refund_amount"))).alias("refunds"),
        F.sum(money_or_zero(F.col("total_revenue_impact"))).alias("impact")).drop("_part")


def merged(parts: DataFrame) -> DataFrame:
    """The dashboard from partials, in the columns of :func:`millrace.plans.sla.sla_dashboard`."""
    whole = parts.groupBy(*GROUPS).agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("longest").alias("longest"),
                                       F.min("shortest").alias("shortest"))
    money = lambda c: F.col(c).cast("decimal(28,2)")
    n = F.col("rows")
    return whole.select(
        *GROUPS, F.col("tickets").alias("total_tickets"),
        percent(F.col("breached"), n).alias("sla_breach_rate_pct"),
        percent(F.col("first_breached"), n).alias("first_response_breach_rate_pct"),
        percent(F.col("resolution_breached"), n).alias("resolution_breach_rate_pct"),
        percent(F.col("reopened"), n).alias("reopen_rate_pct"),
        ratio(F.col("first_time"), F.col("first_times")).alias("avg_first_response_time"),
        ratio(F.col("resolution_time"), F.col("resolution_times")).alias("avg_resolution_time"),
        F.col("longest").alias("max_resolution_time"), F.col("shortest").alias("min_resolution_time"),
        money("refunds").alias("total_refunds"), money("impact").alias("total_revenue_impact"),
        ratio(F.col("refunds"), n).alias("avg_refund_per_ticket"))


class RunningDashboard:
    """Partials in the lake's table ``table``, and the dashboard over them."""

    def __init__(self, lake: Lake, table: str = "sla_dashboard_partials", buckets: int = BUCKETS):
        self.lake = lake
        self.table = BucketedTable(lake.spark, lake.name(table), f"{lake.root}/{table}", ["ticket_id"], buckets)

    def update(self, metrics: DataFrame, changed: DataFrame | None = None) -> int:
        """Bring the partials up to date after the tickets in ``changed`` (``ticket_id``; None: all) changed. Returns how many
        buckets were built anew; metrics are computed for the tickets of these alone."""
        buckets = self.table.buckets
        if changed is None or not self.table.exists():
            touched = list(range(buckets))
        else:
            touched = sorted(r[0] for r in changed.select(ticket_bucket(F.col("ticket_id"), buckets)).distinct().collect())
            metrics = metrics.filter(ticket_bucket(F.col("ticket_id"), buckets).isin(touched))
        if touched:
            self.table.replace(partials(metrics, buckets), touched, dealt=True)
        return len(touched)

    def board(self) -> DataFrame:
        return merged(self.lake.spark.table(self.table.name))
