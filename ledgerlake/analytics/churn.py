"""Snapshots of customers at many cutoffs, with a proxy of churn: no completed purchase within a horizon.

An event goes into the bucket of the first cutoff that may see it, and no other. Buckets are summed per customer, and running
sums over a customer's buckets, at most one for each cutoff, carry events on to all later cutoffs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY
from ledgerlake.plans.marts import total

HORIZON_DAYS = 90
#: Columns of the order totals and of the returns that events are made of.
ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "ordered_quantity", "returned_quantity", "net_sales")
RETURN_COLUMNS = ("order_id", "customer_id", "order_date_key", "return_date_key", "returned_quantity", "returned_revenue")


def quarter_ends(first: date, last: date) -> list[date]:
    """The last days of quarters from ``first`` to ``last``."""
    starts = [date(y, m, 1) for y in range(first.year, last.year + 2) for m in (1, 4, 7, 10)]
    return [d for d in (s - timedelta(days=1) for s in starts) if first <= d <= last]


def customer_events(outcomes: DataFrame, returns: DataFrame) -> DataFrame:
    """What becomes known about a customer on a day: orders placed, and what returns take back from them.

    An order counts as completed from its day on until the day on which the last of it was returned. ``kept_order_date`` is
    set for orders that are never returned in full.
    """
    day = F.to_date(F.col("return_date_key").cast("string"), "yyyyMMdd")
    daily = returns.groupBy("order_id", "customer_id", day.alias("event_date")).agg(
        F.sum("returned_quantity").alias("units"), total("returned_revenue").alias("value")
    )
    upto = F.sum("units").over(Window.partitionBy("order_id").orderBy("event_date"))
    taken = daily.withColumn("upto", upto).join(outcomes.select("order_id", "ordered_quantity"), "order_id")
    ends = (F.col("upto") >= F.col("ordered_quantity")) & (F.col("upto") - F.col("units") < F.col("ordered_quantity"))
    back = taken.select(
        "customer_id", "event_date", F.lit(0).alias("orders"), F.when(ends, -1).otherwise(0).alias("completed"),
        (-F.col("units")).alias("units"), (-F.col("value")).cast(MONEY).alias("value"),
        F.lit(None).cast("date").alias("order_date"), F.lit(None).cast("date").alias("kept_order_date"),
    )
    kept = F.col("ordered_quantity") > F.col("returned_quantity")
    placed = outcomes.select(
        "customer_id", F.col("order_date").alias("event_date"), F.lit(1).alias("orders"), F.lit(1).alias("completed"),
        F.col("ordered_quantity").alias("units"), F.col("net_sales").alias("value"), "order_date",
        F.when(kept, F.col("order_date")).alias("kept_order_date"),
    )
    return placed.unionByName(back)


def _bucket(day: Column, cutoffs: Sequence[date]) -> Column:
    """Number of cutoffs before the day: the place of the first that may see it."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: c < day))


def build_customer_snapshots(events: DataFrame, cutoffs: Sequence[date], horizon_days: int, observed_until: date) -> DataFrame:
    """One row per customer and cutoff, from the customer's first order on.

    Features hold what is known on the cutoff day, the day itself included. ``churned`` is 1 if no order of the days after the cutoff, up to and
    including the last of the horizon, is one that stays (not returned in full); it is NULL where the horizon reaches beyond
    ``observed_until``. Returns alone are no purchase.
    """
    at = sorted(set(cutoffs))
    sums = events.withColumn("bucket", _bucket(F.col("event_date"), at)).groupBy("customer_id", "bucket").agg(
        F.sum("orders").alias("orders"),
        F.sum("completed").alias("completed"),
        F.sum("units").alias("units"),
        total("value"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.min("kept_order_date").alias("first_kept"),
    )
    buckets = Window.partitionBy("customer_id").orderBy("bucket")
    so_far = buckets.rowsBetween(Window.unboundedPreceding, 0)
    later = buckets.rowsBetween(1, Window.unboundedFollowing)
    known = sums.select(
        "customer_id",
        "bucket",
        (F.coalesce(F.lead("bucket").over(buckets), F.lit(len(at))) - 1).alias("until"),
        F.sum("orders").over(so_far).alias("order_count"),
        F.sum("completed").over(so_far).alias("completed_order_count"),
        F.sum("units").over(so_far).alias("net_units"),
        F.sum("value").over(so_far).cast(MONEY).alias("net_value"),
        F.min("first_order").over(so_far).alias("first_order_date"),
        F.max("last_order").over(so_far).alias("last_order_date"),
        F.min("first_kept").over(later).alias("next_kept"),
    )
    seen = known.where((F.col("bucket") < len(at)) & (F.col("order_count") > 0) & (F.col("until") >= F.col("bucket")))
    days = F.array(*[F.lit(c) for c in at]) if at else F.array().cast("array<date>")
    carried = seen.withColumn("cutoff", F.explode(F.slice(days, F.col("bucket") + 1, F.col("until") - F.col("bucket") + 1)))
    ends = F.date_add("cutoff", horizon_days)
    stays = F.coalesce(F.col("next_kept") <= ends, F.lit(False))
    return carried.select(
        "customer_id",
        "cutoff",
        "order_count",
        "completed_order_count",
        "net_units",
        "net_value",
        F.datediff("cutoff", "last_order_date").cast("bigint").alias("recency_days"),
        F.datediff("cutoff", "first_order_date").cast("bigint").alias("tenure_days"),
        F.when(ends <= F.lit(observed_until), F.when(stays, 0).otherwise(1)).alias("churned"),
    )
