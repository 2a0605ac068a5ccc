"""Star schema over conformed tables of one load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, date_key, money
from ledgerlake.operators.bitmaps import maybe_in
from ledgerlake.session import sized


def dim_date(calendar: DataFrame) -> DataFrame:
    """Every day from the first to the last calendar row, with the day's events if any."""
    span = calendar.agg(F.min("event_date").alias("_first"), F.max("event_date").alias("_last"))
    days = span.select(F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias("full_date"))
    day = F.col("full_date")
    return days.join(calendar, day == F.col("event_date"), "left").select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).cast("bigint").alias("year_number"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        (F.dayofweek(day) - 1).cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        "holiday",
        "campaign",
        "seasonal_event",
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "signup_date", "home_city", "segment")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "base_price", "base_cost")


def dim_promotion(promotions: DataFrame) -> DataFrame:
    return promotions.select("promotion_id", "promotion_type", "start_date", "end_date", "discount_policy")


def dim_channel(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("channel").alias("channel_key")).distinct()


def dim_geography(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("home_city").alias("geography_key")).distinct()


def dim_payment_method(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("payment_method").alias("payment_method_key")).distinct()


def _order_context(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order attributes with the customer's city. Joining the smaller order table to customers
    first leaves one shuffle of the line table, on its order."""
    cities = sized(customers.select("customer_id", F.col("home_city").alias("geography_key")))
    return orders.join(cities, "customer_id").select(
        "order_id",
        date_key(F.col("order_timestamp").cast("date")).alias("date_key"),
        "customer_id",
        F.col("channel").alias("channel_key"),
        "geography_key",
        "promotion_id",
        F.col("payment_method").alias("payment_method_key"),
    )


def _extended(quantity: str, price: str) -> Column:
    """Quantity times a price, exactly, in cents."""
    return money(F.col(quantity) * F.col(price))


def sold_lines(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line, without the amounts that follow from the row."""
    lines = items.select(
        "line_id", "order_id", "product_id", F.col("quantity").alias("ordered_quantity"), "unit_price", "unit_cost", "discount_rate"
    )
    return lines.join(_order_context(orders, customers), "order_id").select(
        "line_id",
        "order_id",
        "date_key",
        "customer_id",
        "product_id",
        "channel_key",
        "geography_key",
        "promotion_id",
        "payment_method_key",
        "ordered_quantity",
        "unit_price",
        "unit_cost",
        "discount_rate",
    )


def sales_amounts(lines: DataFrame) -> DataFrame:
    """The amounts that are products. The discount is rounded from the rounded gross amount."""
    return (
        lines.withColumn("gross_sales", _extended("ordered_quantity", "unit_price"))
        .withColumn("discount_amount", money(F.col("gross_sales") * F.col("discount_rate")))
        .withColumn("cogs", _extended("ordered_quantity", "unit_cost"))
    )


def with_sales_differences(lines: DataFrame) -> DataFrame:
    """Add what is left of them: net sales and gross profit."""
    gross, discount, cogs = F.col("gross_sales"), F.col("discount_amount"), F.col("cogs")
    return lines.select(
        *[c for c in lines.columns if c != "cogs"],
        (gross - discount).cast(MONEY).alias("net_sales"),
        "cogs",
        (gross - discount - cogs).cast(MONEY).alias("gross_profit"),
    )


def with_sales_amounts(lines: DataFrame) -> DataFrame:
    return with_sales_differences(sales_amounts(lines))


def fact_sales(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line."""
    return with_sales_amounts(sold_lines(items, orders, customers))


def returned_lines(returns: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per return event, with the order's day beside the day of return, without the amounts that follow from the row.
    The sale that is returned has all else, so this is one join; most sales that were not returned stay out of its shuffle."""
    lines = sales.select(
        "line_id",
        "order_id",
        F.col("date_key").alias("order_date_key"),
        "customer_id",
        "product_id",
        "channel_key",
        "geography_key",
        "promotion_id",
        "payment_method_key",
        "unit_price",
        "unit_cost",
        "discount_rate",
    )
    events = returns.select(
        "return_id", "line_id", date_key(F.col("return_date")).alias("return_date_key"), "returned_quantity",
        F.col("reason").alias("return_reason"),
    )
    return events.join(maybe_in(lines, "line_id", returns), "line_id").select(
        "return_id",
        "line_id",
        "order_id",
        "return_date_key",
        "order_date_key",
        "customer_id",
        "product_id",
        "channel_key",
        "geography_key",
        "promotion_id",
        "payment_method_key",
        "returned_quantity",
        "return_reason",
        "unit_price",
        "unit_cost",
        "discount_rate",
    )


def return_amounts(lines: DataFrame) -> DataFrame:
    """The refunded revenue is rounded once, from quantity, price and discount together."""
    kept_share = 1 - F.col("discount_rate")
    return lines.withColumn("returned_revenue", money(F.col("returned_quantity") * F.col("unit_price") * kept_share)).withColumn(
        "reversed_cogs", _extended("returned_quantity", "unit_cost")
    )


def with_return_differences(lines: DataFrame) -> DataFrame:
    return lines.select("*", (F.col("returned_revenue") - F.col("reversed_cogs")).cast(MONEY).alias("profit_impact"))


def with_return_amounts(lines: DataFrame) -> DataFrame:
    return with_return_differences(return_amounts(lines))


def fact_returns(returns: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per return event."""
    return with_return_amounts(returned_lines(returns, sales))
