"""Money columns, grouped tables and the KPI summary of the cleaned sheet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, money
from ledgerlake.operators.cleaning import SHEET_RATE, UNKNOWN

GROUPINGS = {
    "Product_Analysis": ("Product", "Category"),
    "Category_Analysis": ("Category",),
    "City_Analysis": ("City",),
    "Monthly_Sales": ("Month",),
    "Payment_Analysis": ("Payment_Method",),
}
_MONEY_COLUMNS = ("Gross_Sales_USD", "Discount_Amount_USD", "Net_Revenue_USD")


def add_calculated_columns(clean: DataFrame) -> DataFrame:
    """Row-level money, rounded at each step, and calendar columns."""
    gross, discount = F.col("Gross_Sales_USD"), F.col("Discount_Amount_USD")
    return (
        clean.withColumn("Gross_Sales_USD", money(F.col("Quantity").cast("decimal(12,0)") * F.col("Unit_Price_USD")))
        .withColumn("Discount_Amount_USD", money(gross * F.col("Discount_Rate").cast(SHEET_RATE)))
        .withColumn("Net_Revenue_USD", (gross - discount).cast(MONEY))
        .withColumn("Year", F.year("Order_Date").cast("bigint"))
        .withColumn("Month", F.date_format("Order_Date", "yyyy-MM"))
        .withColumn("Month_Name", F.date_format("Order_Date", "MMMM"))
    )


def _rounded_quotient(numerator: Column, denominator: Column) -> Column:
    """Exact decimal division rounded to cents; NULL when dividing by zero."""
    exact = F.try_divide(numerator.cast("decimal(28,2)"), denominator.cast("decimal(28,2)"))
    return money(exact)


def build_grouped_analysis(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Units, distinct orders, money, average order value and share of all revenue per group.

    Amounts are summed before any shuffle; orders are counted apart, so that what crosses a shuffle by order are keys without amounts."""
    all_revenue = lines.agg(F.sum("Net_Revenue_USD")).scalar()
    amounts = lines.groupBy(*keys).agg(
        F.sum("Quantity").alias("Units_Sold"), *[F.sum(c).cast(MONEY).alias(c) for c in _MONEY_COLUMNS]
    )
    orders = lines.select(*keys, "Order_ID").distinct().groupBy(*keys).agg(F.count("Order_ID").alias("Orders"))
    measures = ("Units_Sold", "Orders", *_MONEY_COLUMNS)
    # One row of each kind for a group; groups may be NULL, which a join would part.
    grouped = amounts.unionByName(orders, allowMissingColumns=True).groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    net = F.col("Net_Revenue_USD")
    return grouped.withColumns(
        {
            "Average_Order_Value_USD": _rounded_quotient(net, F.col("Orders")),
            "Revenue_Share_Pct": _rounded_quotient(net * 100, all_revenue),
        }
    )


def ranked(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """By revenue, largest first; months in calendar order."""
    if keys == ("Month",):
        return table.orderBy("Month")
    return table.orderBy(F.desc("Net_Revenue_USD"), *keys)


def analysis_tables(lines: DataFrame) -> dict[str, DataFrame]:
    return {name: ranked(build_grouped_analysis(lines, keys), keys) for name, keys in GROUPINGS.items()}


def totals(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.coalesce(F.sum("Quantity"), F.lit(0)).alias("units"),
        F.countDistinct("Order_ID").alias("orders"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast(MONEY).alias(c) for c in _MONEY_COLUMNS],
    )


def kpi_summary(lines: DataFrame) -> DataFrame:
    """Fourteen (Metric, Value) rows; values as text. Ties are broken by name."""
    gross, discount, net = (F.col(c) for c in _MONEY_COLUMNS)
    text = lambda column: column.cast("string")
    # Metric names.
    headline = totals(lines).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("Metric"), text(value).alias("Value"))
                    for name, value in (
                        ("Total Gross Sales (USD)", gross),
                        ("Total Discount (USD)", discount),
                        ("Total Net Revenue (USD)", net),
                        ("Total Orders", F.col("orders")),
                        ("Total Units Sold", F.col("units")),
                        ("Average Order Value (USD)", _rounded_quotient(net, F.col("orders"))),
                        ("Average Selling Price (USD)", _rounded_quotient(net, F.col("units"))),
                        ("Effective Discount Rate (%)", _rounded_quotient(discount * 100, gross)),
                    )
                ]
            )
        )
    )
    tables = {name: build_grouped_analysis(lines, keys) for name, keys in GROUPINGS.items()}
    product = tables["Product_Analysis"]
    best = lambda table, metric, column, *order: (
        table.orderBy(*order, column).limit(1).select(F.lit(metric).alias("Metric"), F.col(column).alias("Value"))
    )
    revenue = F.desc("Net_Revenue_USD")
    winners = [
        best(product, "Top-Selling Product", "Product", F.desc("Units_Sold"), revenue),
        best(product, "Highest-Revenue Product", "Product", revenue),
        best(tables["Category_Analysis"], "Highest-Revenue Category", "Category", revenue),
        best(tables["City_Analysis"].where(F.col("City") != UNKNOWN), "Highest-Revenue City", "City", revenue),
        best(tables["Monthly_Sales"], "Best Revenue Month", "Month", revenue),
        best(tables["Payment_Analysis"], "Most-Used Payment Method", "Payment_Method", F.desc("Orders"), revenue),
    ]
    return reduce(DataFrame.unionByName, [headline, *winners])


def reconcile_tables(lines: DataFrame) -> DataFrame:
    """Revenue of each grouped table against the total, within a cent."""
    total = lines.agg(F.coalesce(F.sum("Net_Revenue_USD"), F.lit(0)).cast(MONEY)).scalar()
    sums = [
        lines.groupBy(*keys)
        .agg(F.sum("Net_Revenue_USD").cast(MONEY).alias("net"))
        .agg(F.coalesce(F.sum("net"), F.lit(0)).cast(MONEY).alias("table_revenue"))
        .select(F.lit(name).alias("table_name"), "table_revenue")
        for name, keys in GROUPINGS.items()
    ]
    return reduce(DataFrame.unionByName, sums).withColumns(
        {"total_revenue": total, "reconciled": F.abs(F.col("table_revenue") - total) <= 0.01}
    )


def run_result(raw: DataFrame, clean: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: size before and after cleaning, and the headline totals."""
    return totals(lines).select(
        raw.agg(F.count("*")).scalar().alias("raw_rows"),
        clean.agg(F.count("*")).scalar().alias("clean_rows"),
        F.col("orders").alias("unique_orders"),
        F.col("units").alias("units_sold"),
        F.col("Gross_Sales_USD").alias("gross_sales"),
        F.col("Net_Revenue_USD").alias("net_revenue"),
    )
