"""Business signals over one batch: season, trend, promotion, channel, affinity, loyalty, returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, ratio, week_start
from ledgerlake.operators.bitmaps import maybe_in
from ledgerlake.plans.marts import _calendar

PEAK_MONTHS = (10, 11, 12)
BASE_MONTHS = (4, 5, 6)


def season_lift(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue of the peak months against the baseline months."""
    by_day = sales.groupBy("date_key").agg(F.sum("net_sales").alias("net"))
    month = F.month("full_date")
    revenue = lambda months: F.coalesce(F.sum(F.when(month.isin(*months), F.col("net"))), F.lit(0)).cast(MONEY)
    return (
        by_day.join(_calendar(dates), "date_key")
        .agg(revenue(PEAK_MONTHS).alias("peak_revenue"), revenue(BASE_MONTHS).alias("base_revenue"))
        .withColumn("lift", ratio(F.col("peak_revenue"), F.col("base_revenue")))
    )


def yearly_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.year("order_timestamp").cast("bigint").alias("order_year")).agg(F.count("*").alias("order_count"))


def _control_window(day: Column) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).between(915, 1015)


def promotion_effect(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders and line discounts inside promotions and inside the control window before them."""
    promoted = F.col("promotion_id").isNotNull()
    control = _control_window(F.col("order_timestamp"))
    grouped = orders.select("order_id", promoted.alias("promoted"), control.alias("control")).where("promoted or control")
    counts = grouped.agg(
        F.count_if("promoted").alias("promoted_orders"), F.count_if("control").alias("control_orders")
    )
    rate = lambda test: F.avg(F.when(test, F.col("discount_rate").cast("double")))
    lines = (
        items.select("order_id", "discount_rate")
        .join(grouped, "order_id")
        .agg(
            F.count_if("promoted").alias("promoted_lines"),
            F.count_if("control").alias("control_lines"),
            rate(F.col("promoted")).alias("promoted_discount"),
            rate(F.col("control")).alias("control_discount"),
        )
    )
    both = counts.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def channel_share(orders: DataFrame) -> DataFrame:
    known = orders.where(F.col("channel").isNotNull())
    everything = known.agg(F.count("*")).scalar()
    return known.groupBy("channel").agg(F.count("*").alias("order_count")).withColumn(
        "share", ratio(F.col("order_count"), everything)
    )


def product_affinity(items: DataFrame, sources: Sequence[str], target: str) -> DataFrame:
    """How often orders with and without a source product contain the target product.

    Two flags per order instead of a set of products: they combine map-side."""
    baskets = items.groupBy("order_id").agg(
        F.max(F.col("product_id").isin(*sources)).alias("with_source"),
        F.max(F.col("product_id") == target).alias("with_target"),
    )
    return baskets.groupBy("with_source").agg(
        F.count("*").alias("order_count"),
        F.count_if("with_target").alias("target_orders"),
        ratio(F.count_if("with_target"), F.count("*")).alias("target_rate"),
    )


def repeat_customers(orders: DataFrame) -> DataFrame:
    """Customers with one order and with several, and the years of the single orders."""
    per_customer = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.min(F.year("order_timestamp")).alias("first_year")
    )
    single = F.col("n") == 1
    return per_customer.agg(
        F.count_if(single).alias("single_purchase_customers"),
        F.count_if(F.col("n") > 1).alias("repeat_customers"),
        F.min(F.when(single, F.col("first_year"))).cast("bigint").alias("single_first_year"),
        F.max(F.when(single, F.col("first_year"))).cast("bigint").alias("single_last_year"),
    )


def partial_returns(returns: DataFrame, items: DataFrame) -> DataFrame:
    lines = maybe_in(items.select("line_id", "quantity"), "line_id", returns)
    joined = returns.select("line_id", "returned_quantity").join(lines, "line_id")
    return joined.agg(
        F.count_if(F.col("returned_quantity") < F.col("quantity")).alias("partial_returns"),
        F.count_if(F.col("returned_quantity") == F.col("quantity")).alias("full_returns"),
    )


def cross_week_returns(returns: DataFrame, dates: DataFrame) -> DataFrame:
    """Returns that came back in another week than the order's: the calendar plays two roles."""
    ordered = dates.select(F.col("date_key").alias("order_date_key"), week_start(F.col("full_date")).alias("order_week"))
    came_back = dates.select(F.col("date_key").alias("return_date_key"), week_start(F.col("full_date")).alias("return_week"))
    pairs = returns.groupBy("order_date_key", "return_date_key").agg(F.count("*").alias("n"))
    return (
        pairs.join(ordered, "order_date_key")
        .join(came_back, "return_date_key")
        .where(F.col("order_week") != F.col("return_week"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cross_week_returns"))
    )
