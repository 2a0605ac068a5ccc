"""Analytic marts over the star schema.

Sales and returns are first summed by the same three columns (order, customer, order day), or
by those plus the product. An order has one customer and one day, so the extra columns do not
change the groups; they give both sides the same hash partitioning, and the join between the
two roll-ups needs no further shuffle. Sums are taken map-side before each shuffle, so an order,
customer or product that owns a large share of the lines arrives as a few partial rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, month_diff, month_start, ratio, week_start
from ledgerlake.operators.groups import attach_group_value
from ledgerlake.session import sized, stored

SALES_MONEY = ("gross_sales", "discount_amount", "net_sales", "cogs", "gross_profit")
RETURN_MONEY = ("returned_revenue", "reversed_cogs", "profit_impact")
ORDER_KEYS = ("order_id", "customer_id", "date_key")


def total(column: str) -> Column:
    """Sum of a money column, taken in whole cents: a sum of decimals is more than four times as wide in a shuffle."""
    cents = F.sum((F.col(column).cast(MONEY) * 100).cast("bigint"))
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias(column)


def _units(column: str) -> Column:
    return F.sum(column).cast("bigint").alias(column)


def _zero_if_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def sales_rollup(sales: DataFrame, *more_keys: str, measures=SALES_MONEY) -> DataFrame:
    return sales.groupBy(*ORDER_KEYS, *more_keys).agg(_units("ordered_quantity"), *[total(m) for m in measures])


def returns_rollup(returns: DataFrame, *more_keys: str, measures=RETURN_MONEY) -> DataFrame:
    """Returns summed under the order's day, whatever the day of return."""
    return (
        returns.withColumnRenamed("order_date_key", "date_key")
        .groupBy(*ORDER_KEYS, *more_keys)
        .agg(_units("returned_quantity"), *[total(m) for m in measures])
    )


def _with_returns(sold: DataFrame, returned: DataFrame, *more_keys: str) -> DataFrame:
    measures = [c for c in returned.columns if c not in (*ORDER_KEYS, *more_keys)]
    joined = sold.join(returned, [*ORDER_KEYS, *more_keys], "left")
    return joined.select(*sold.columns, *[F.coalesce(F.col(c), F.lit(0)).cast(_kind(c)).alias(c) for c in measures])


def _kind(column: str) -> str:
    return "bigint" if column.endswith("quantity") else MONEY


def _calendar(dates: DataFrame) -> DataFrame:
    return dates.select("date_key", "full_date")


def mart_executive(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row. Orders are rolled up first: that counts distinct orders by the way, and the
    distinct customers are then counted over orders instead of lines."""
    orders = sales.groupBy("order_id", "customer_id").agg(
        F.count("*").alias("sales_line_count"), _units("ordered_quantity"), *[total(m) for m in SALES_MONEY]
    )
    sold = orders.agg(
        F.coalesce(F.sum("sales_line_count"), F.lit(0)).cast("bigint").alias("sales_line_count"),
        F.count("*").alias("order_count"),
        F.countDistinct("customer_id").alias("customer_count"),
        _units("ordered_quantity"),
        *[total(m) for m in SALES_MONEY],
    )
    returned = returns.agg(
        F.count("*").alias("return_event_count"),
        F.coalesce(F.sum("returned_quantity"), F.lit(0)).cast("bigint").alias("returned_quantity"),
        *[F.coalesce(F.sum(m), F.lit(0)).cast(MONEY).alias(m) for m in RETURN_MONEY],
    )
    # Two one-row results side by side: stack them and take the only value of each column.
    stacked = sold.unionByName(returned, allowMissingColumns=True)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return row.select(
        "*",
        (F.col("net_sales") - F.col("returned_revenue")).cast(MONEY).alias("return_adjusted_revenue"),
        (F.col("gross_profit") - F.col("profit_impact")).cast(MONEY).alias("return_adjusted_profit"),
    )


def order_outcomes(sales: DataFrame, returns: DataFrame, dates: DataFrame, returned=RETURN_MONEY) -> DataFrame:
    """One row per order: sales, returns, order date."""
    return (
        _with_returns(sales_rollup(sales), returns_rollup(returns, measures=returned))
        .join(_calendar(dates), "date_key")
        .withColumnRenamed("full_date", "order_date")
    )


def mart_customer_360(customers: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per accepted customer, from the written ``order_outcomes``."""
    completed = F.col("ordered_quantity") > F.col("returned_quantity")
    measures = ("gross_sales", "discount_amount", "net_sales", "returned_revenue", "cogs", "reversed_cogs", "gross_profit", "profit_impact")
    metrics = (
        outcomes.groupBy("customer_id")
        .agg(
            F.min(F.when(completed, F.col("order_date"))).alias("first_purchase_date"),
            F.max(F.when(completed, F.col("order_date"))).alias("last_purchase_date"),
            F.count("*").alias("order_count"),
            F.count_if(completed).alias("completed_order_count"),
            _units("ordered_quantity"),
            _units("returned_quantity"),
            *[total(m) for m in measures],
        )
    )
    counts = ("order_count", "completed_order_count", "ordered_quantity", "returned_quantity")
    filled = customers.join(metrics, "customer_id", "left").select(
        *customers.columns,
        "first_purchase_date",
        "last_purchase_date",
        *[_zero_if_null(c) for c in counts],
        *[F.coalesce(F.col(m), F.lit(0)).cast(MONEY).alias(m) for m in measures],
    )
    return filled.select(
        "*",
        (F.col("net_sales") - F.col("returned_revenue")).cast(MONEY).alias("return_adjusted_value"),
        (F.col("gross_profit") - F.col("profit_impact")).cast(MONEY).alias("return_adjusted_profit"),
    )


def mart_cohort_base(outcomes: DataFrame) -> DataFrame:
    """Orders not fully returned, with the month of the customer's first such order.

    The first month is an aggregate brought back to the orders rather than a window over the
    customer, so that a customer with very many orders is not gathered in one task. It is read twice and
    hence written; both branches scan the written ``order_outcomes``, each with the few columns it needs.
    """
    completed = outcomes.where(F.col("ordered_quantity") > F.col("returned_quantity")).withColumn(
        "order_month", month_start(F.col("order_date"))
    )
    first = stored(
        completed.groupBy("customer_id").agg(F.min("order_month").alias("acquisition_cohort_month"), F.count("*").alias("orders"))
    )
    dated = attach_group_value(completed, "customer_id", first, "acquisition_cohort_month", "orders", spread="order_id")
    return dated.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_month",
        "acquisition_cohort_month",
        month_diff(F.col("order_month"), F.col("acquisition_cohort_month")).alias("months_since_acquisition"),
        "ordered_quantity",
        "returned_quantity",
        (F.col("ordered_quantity") - F.col("returned_quantity")).alias("retained_quantity"),
        "net_sales",
        "returned_revenue",
        (F.col("net_sales") - F.col("returned_revenue")).cast(MONEY).alias("return_adjusted_value"),
    )


def purchase_months(outcomes: DataFrame) -> DataFrame:
    """The months in which a customer has orders of ``mart_cohort_base``, once each, with the month of the first: all that retention counts.

    A customer's months, at most one for each month of the calendar, are gathered map-side and in one shuffle. ``outcomes`` may be a plan:
    only its keys, days and quantities are asked for.
    """
    completed = outcomes.where(F.col("ordered_quantity") > F.col("returned_quantity"))
    months = completed.groupBy("customer_id").agg(F.collect_set(month_start(F.col("order_date"))).alias("_months"))
    dated = months.select("customer_id", F.array_min("_months").alias("acquisition_cohort_month"), F.explode("_months").alias("order_month"))
    return dated.withColumn("months_since_acquisition", month_diff(F.col("order_month"), F.col("acquisition_cohort_month")))


def mart_basket_base(sales: DataFrame, returns: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Products kept in an order after returns."""
    outcomes = _with_returns(
        sales_rollup(sales, "product_id", measures=("net_sales",)),
        returns_rollup(returns, "product_id", measures=("returned_revenue",)),
        "product_id",
    )
    return (
        outcomes.where(F.col("ordered_quantity") > F.col("returned_quantity"))
        .join(_calendar(dates), "date_key")
        .join(sized(products.select("product_id", "product_name", "category")), "product_id")
        .select(
            "order_id",
            "customer_id",
            F.col("full_date").alias("order_date"),
            "product_id",
            "product_name",
            "category",
            "ordered_quantity",
            "returned_quantity",
            (F.col("ordered_quantity") - F.col("returned_quantity")).alias("remaining_quantity"),
            "net_sales",
            "returned_revenue",
            (F.col("net_sales") - F.col("returned_revenue")).cast(MONEY).alias("return_adjusted_value"),
        )
    )


def week_grid(dates: DataFrame, products: DataFrame) -> DataFrame:
    """Every calendar week for every product category, with the week's special days.

    The calendar has no gaps, so each category carries the list of Mondays of the whole span.
    """
    weeks = dates.groupBy(week_start(F.col("full_date")).alias("week_start")).agg(
        F.count("holiday").alias("holiday_days"), F.count("campaign").alias("campaign_days")
    )
    first, last = F.min(week_start(F.col("full_date"))), F.max(week_start(F.col("full_date")))
    # One row, one array of the calendar's Mondays: bounded by the calendar, not by the facts.
    mondays = dates.select(F.sequence(first, last, F.expr("interval 7 days")).alias("m")).scalar()
    categories = products.select("category").distinct()
    return categories.select("category", F.explode(mondays).alias("week_start")).join(weeks, "week_start")


def category_weeks_of_sales(sales: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Weekly sales per category. Amounts are summed by day before any shuffle; orders are counted apart, so that what crosses
    a shuffle by order are keys without amounts."""
    channels = {"online": "Online", "store": "Store", "marketplace": "Marketplace"}
    lines = sales.join(sized(products.select("product_id", "category")), "product_id")
    amounts = lines.groupBy("date_key", "category").agg(
        _units("ordered_quantity"),
        *[total(m) for m in SALES_MONEY],
        *[F.sum(F.when(F.col("channel_key") == key, F.col("ordered_quantity"))).alias(f"_{name}") for name, key in channels.items()],
    )
    orders = lines.select("order_id", "category", "date_key", "channel_key", F.col("promotion_id").isNotNull().alias("promoted")).distinct()
    counts = orders.groupBy("date_key", "category").agg(F.count("*").alias("_orders"), F.count_if("promoted").alias("_promoted"))
    units = F.sum("ordered_quantity")
    return (
        amounts.unionByName(counts, allowMissingColumns=True)
        .join(_calendar(dates), "date_key")
        .groupBy(week_start(F.col("full_date")).alias("week_start"), "category")
        .agg(
            F.sum("_orders").alias("order_count"),
            _units("ordered_quantity"),
            *[total(m) for m in SALES_MONEY],
            ratio(F.sum("gross_sales"), units).alias("average_unit_price"),
            ratio(F.sum("discount_amount"), F.sum("gross_sales")).alias("effective_discount_rate"),
            F.sum("_promoted").alias("promoted_order_count"),
            *[ratio(F.sum(f"_{name}"), units).alias(f"{name}_unit_share") for name in channels],
        )
    )


def category_weeks_of_returns(returns: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Returns per category under the week of the order."""
    return (
        returns.join(sized(products.select("product_id", "category")), "product_id")
        .groupBy(F.col("order_date_key").alias("date_key"), "category")
        .agg(_units("returned_quantity"), *[total(m) for m in RETURN_MONEY])
        .join(_calendar(dates), "date_key")
        .groupBy(week_start(F.col("full_date")).alias("week_start"), "category")
        .agg(_units("returned_quantity"), *[total(m) for m in RETURN_MONEY])
    )


def mart_forecasting_base(sales: DataFrame, returns: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    keys = ["week_start", "category"]
    joined = (
        week_grid(dates, products)
        .join(category_weeks_of_sales(sales, dates, products), keys, "left")
        .join(category_weeks_of_returns(returns, dates, products), keys, "left")
    )
    counts = ("order_count", "ordered_quantity", "returned_quantity", "promoted_order_count")
    shares = ("online_unit_share", "store_unit_share", "marketplace_unit_share")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts}
    zero |= {c: F.coalesce(F.col(c), F.lit(0)).cast(MONEY) for c in (*SALES_MONEY, *RETURN_MONEY)}
    zero |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in shares}
    filled = joined.withColumns(zero)
    return filled.select(
        "week_start",
        "category",
        "holiday_days",
        "campaign_days",
        "order_count",
        "ordered_quantity",
        "returned_quantity",
        "gross_sales",
        "discount_amount",
        "net_sales",
        "returned_revenue",
        (F.col("net_sales") - F.col("returned_revenue")).cast(MONEY).alias("return_adjusted_revenue"),
        "cogs",
        "reversed_cogs",
        "gross_profit",
        "profit_impact",
        (F.col("gross_profit") - F.col("profit_impact")).cast(MONEY).alias("return_adjusted_profit"),
        "average_unit_price",
        "effective_discount_rate",
        "promoted_order_count",
        *shares,
    )
