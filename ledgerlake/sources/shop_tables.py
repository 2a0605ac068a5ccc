"""Retail source tables and the flat order-line sheet, derived from order-entry tables.

The input tables are the TPC-H-like ``customer nation part orders lineitem``. Every entity is a
projection of a whole table; the only joins add names from parent tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import date_key, season
from ledgerlake.schemas import FLAT_COLUMNS, SOURCE_ROW, SourceTables, Vocabulary
from ledgerlake.sources.readers import read_parquet

# Codes of the order-entry tables.
CHANNEL_OF_STATUS = {"O": "Online", "F": "Store", "P": "Marketplace"}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REASONS = ("Damaged", "Changed mind", "Wrong item")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def _id(prefix: str, *parts) -> Column:
    return F.concat_ws("-", F.lit(prefix), *[F.col(p) if isinstance(p, str) else p for p in parts])


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _line_parts() -> list:
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", date_key(F.col("l_shipdate"))]


def _in_campaign(day: Column) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).between(1115, 1215)


def batch_dates(orders: DataFrame):
    """First day of the first year, last day of the last complete month: one row, two dates."""
    row = orders.select(
        F.trunc(F.min("o_orderdate").cast("date"), "year").alias("start"),
        F.last_day(F.add_months(F.max("o_orderdate").cast("date"), -1)).alias("end"),
    ).first()
    return row["start"], row["end"]


def customers(spark, folder) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    return (
        _table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _id("C", "c_custkey").alias("customer_id"),
            F.date_sub(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 731).cast("int")).alias(
                "signup_date"
            ),
            F.col("n_name").alias("home_city"),
            F.col("c_mktsegment").alias("segment"),
            SOURCE_ROW,
        )
    )


def products(spark, folder) -> DataFrame:
    cost_cents = F.expr("cast(round(p_retailprice * 100) as bigint) * 70 div 100")
    return _table(spark, folder, "part").select(
        _id("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        (cost_cents / 100.0).alias("base_cost"),
        SOURCE_ROW,
    )


def orders(spark, folder) -> DataFrame:
    channel = F.lit(None).cast("string")
    for status, name in CHANNEL_OF_STATUS.items():
        channel = F.when(F.col("o_orderstatus") == status, name).otherwise(channel)
    urgency = F.substring("o_orderpriority", 1, 1)
    return _table(spark, folder, "orders").select(
        _id("O", "o_orderkey").alias("order_id"),
        _id("C", "o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        channel.alias("channel"),
        F.when(urgency.isin("1", "2"), "Credit Card")
        .when(urgency == "3", "Debit Card")
        .otherwise("Digital Wallet")
        .alias("payment_method"),
        F.when(_in_campaign(F.col("o_orderdate")), _id("PROMO", F.year("o_orderdate"))).alias("promotion_id"),
        SOURCE_ROW,
    )


def order_items(spark, folder) -> DataFrame:
    price_cents = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    return (
        _table(spark, folder, "lineitem")
        .withColumn("_price", price_cents)
        .select(
            _id("L", *_line_parts()).alias("line_id"),
            _id("O", "l_orderkey").alias("order_id"),
            _id("P", "l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("_price") / 100.0).alias("unit_price"),
            (F.expr("_price * 70 div 100") / 100.0).alias("unit_cost"),
            F.col("l_discount").alias("discount_rate"),
            SOURCE_ROW,
        )
    )


def returns(spark, folder) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    reason = F.element_at(
        F.array(*[F.lit(text) for text in REASONS]), (F.col("l_suppkey") % 3 + 1).cast("int")
    )
    return (
        _table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            _id("R", *_line_parts()).alias("return_id"),
            _id("L", *_line_parts()).alias("line_id"),
            F.col("l_shipdate").cast("date").alias("return_date"),
            F.when(F.col("l_linestatus") == "F", quantity)
            .otherwise(F.greatest(F.floor(quantity / 2).cast("bigint"), F.lit(1)))
            .alias("returned_quantity"),
            reason.alias("reason"),
            SOURCE_ROW,
        )
    )


def promotions(spark, folder) -> DataFrame:
    year = F.col("_year")
    return (
        spark.read.parquet(f"{folder}/orders.parquet")
        .select(F.year("o_orderdate").alias("_year"))
        .distinct()
        .select(
            _id("PROMO", year).alias("promotion_id"),
            F.lit("holiday").alias("promotion_type"),
            F.make_date(year, F.lit(11), F.lit(15)).alias("start_date"),
            F.make_date(year, F.lit(12), F.lit(15)).alias("end_date"),
            F.lit(0.10).alias("discount_policy"),
            (F.row_number().over(Window.orderBy("_year")) - 1).cast("bigint").alias(SOURCE_ROW)  # one row per year,
        )
    )


def calendar_events(spark, folder) -> DataFrame:
    """One row per day of the batch, spanned from the order dates."""
    bounds = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.trunc(F.min("o_orderdate").cast("date"), "year").alias("_start"),
        F.last_day(F.add_months(F.max("o_orderdate").cast("date"), -1)).alias("_end"),
    )
    day = F.col("date")
    return bounds.select(
        F.posexplode(F.expr("sequence(_start, _end, interval 1 day)")).alias("_pos", "date")
    ).select(
        "date",
        F.when((F.month(day) == 1) & (F.dayofmonth(day) == 1), "New Year").alias("holiday"),
        F.when(_in_campaign(day), _id("PROMO", F.year(day))).alias("campaign"),
        season(day).alias("seasonal_event"),
        F.col("_pos").cast("bigint").alias(SOURCE_ROW),
    )


def shop_batch(spark: SparkSession, folder: str) -> SourceTables:
    start, end = batch_dates(spark.read.parquet(f"{folder}/orders.parquet"))
    return SourceTables(
        customers=customers(spark, folder),
        products=products(spark, folder),
        orders=orders(spark, folder),
        order_items=order_items(spark, folder),
        returns=returns(spark, folder),
        promotions=promotions(spark, folder),
        calendar_events=calendar_events(spark, folder),
        start_date=start,
        end_date=end,
        vocabulary=Vocabulary(segments=SEGMENTS),
    )


def pair_keyed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines keyed by order and line number only; that pair repeats in the input."""
    return _table(spark, folder, "lineitem").select(_id("L", "l_orderkey", "l_linenumber").alias("line_id"), SOURCE_ROW)


def closed_batch(batch: SourceTables) -> SourceTables:
    """The whole batch, with other keys for orders and shipments after its end date: every row is
    there, and lines and returns that refer to them lack their parents."""
    end, shipped = F.lit(batch.end_date), F.to_date(F.substring_index("line_id", "-", -1), "yyyyMMdd")

    def renamed(df: DataFrame, key: str, late: Column) -> DataFrame:
        return df.withColumn(key, F.when(late, F.concat(F.lit("late-"), key)).otherwise(F.col(key)))

    return batch.replace(
        orders=renamed(batch.orders, "order_id", F.col("order_timestamp").cast("date") > end),
        order_items=renamed(batch.order_items, "line_id", shipped > end),
    )


# --- flat order-line sheet -------------------------------------------------------------------

FLAT_YEARS = (1995, 2000)


def approved_categories(spark, folder) -> DataFrame:
    """Product -> category map: one row per brand."""
    return (
        spark.read.parquet(f"{folder}/part.parquet")
        .select(F.col("p_brand").alias("Product"))
        .distinct()
        .withColumn("Category", _id("Cat", F.expr("cast(substring(Product, 7) as int) % 5")))
    )


def flat_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as one wide sheet in which a known share of rows carries each kind of defect.

    ``_m`` spreads rows over 0..999; each defect takes a fixed range of it, and every line is
    kept. Lines with ``_m`` in 60..67 appear twice, as exact copies. Orders meet customers before they
    meet lines, and lines cross two shuffles, by product and by order, before texts are built from them.
    """
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    m = F.col("_m")
    ordered = (
        read("orders")
        .join(read("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_orderdate"), "c_nationkey")
    )
    wide = (
        _table(spark, folder, "lineitem")
        .withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
        .join(read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("_m", F.expr("(l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 1000"))
        .withColumn("_price", F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)"))
        .withColumn("_city", F.initcap("n_name"))
        .withColumn("_brand", F.expr("cast(substring(p_brand, 7) as int)"))
    )
    urgency = F.substring("o_orderpriority", 1, 1)
    payment = (
        F.when(urgency == "1", "Credit Card")
        .when(urgency == "2", "Debit Card")
        .when(urgency == "3", "PayPal")
        .otherwise("Bank Transfer")
    )
    columns = {
        "Order_Line_ID": _id("L", *_line_parts()),
        "Order_ID": _id("O", "l_orderkey"),
        "Order_Date": F.when(m.between(48, 50), "not-a-date")
        .when(m.between(51, 52), "2025-13-40")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "Customer_ID": _id("C", "o_custkey"),
        "Product": F.col("p_brand"),
        "Category": _id("Cat", F.when(m.between(53, 57), F.col("_brand") + 1).otherwise(F.col("_brand")) % 5),
        "City": F.when(m.between(0, 7), F.lit(None).cast("string"))
        .when(m.between(8, 15), F.concat(F.lit("  "), F.col("_city"), F.lit(" ")))
        .when(m.between(16, 19), F.upper("_city"))
        .when(m.between(20, 23), F.lower("_city"))
        .otherwise(F.col("_city")),
        "Quantity": F.when(m.between(32, 33), "0")
        .when(m.between(34, 35), "-1")
        .when(m.between(36, 37), "three")
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")),
        "Unit_Price_USD": F.when(m.between(38, 40), F.lit(0.0))
        .when(m.between(41, 42), F.lit(-25.0))
        .otherwise(F.col("_price") / 100.0),
        "Discount_Rate": F.when(m.between(43, 45), F.lit(1.2))
        .when(m.between(46, 47), F.lit(-0.1))
        .otherwise(F.col("l_discount")),
        "Payment_Method": F.when(m.between(24, 31), F.lit(None).cast("string")).otherwise(payment),
    }
    first = F.col(SOURCE_ROW) * 2
    positions = F.when(m.between(60, 67), F.array(first, first + 1)).otherwise(F.array(first))
    return wide.select(
        *[columns[name].alias(name) for name in FLAT_COLUMNS],
        F.explode(positions).alias(SOURCE_ROW),
    )


# --- the same batch with every kind of defect ---------------------------------------------------

#: Single rows whose key is lost. More than one would count as a repeated key, and lookups by that key would be skipped.
LOST_KEY_ROW = 17
#: By table: every how many rows a defect comes, and (place, column, value) of each; values are SQL over the row.
DEFECTS = {
    "customers": (53, (
        (1, "customer_id", "NULL"), (2, "signup_date", "NULL"), (3, "home_city", "NULL"), (4, "segment", "NULL"), (5, "customer_id", "'C-1'"),
        (6, "segment", "'Nobody'"), (7, "signup_date", "DATE '2099-01-01'"),
    )),
    "products": (53, (
        (1, "product_id", "NULL"), (2, "name", "NULL"), (3, "category", "NULL"), (4, "base_price", "NULL"), (5, "base_cost", "NULL"),
        (6, "base_price", "0"), (7, "base_cost", "-1"), (8, "base_cost", "base_price + 1"), (9, "product_id", "'P-1'"),
    )),
    "orders": (211, (
        (2, "customer_id", "NULL"), (3, "order_timestamp", "NULL"), (4, "channel", "NULL"), (5, "payment_method", "NULL"), (6, "channel", "'Fax'"),
        (7, "payment_method", "'Barter'"), (8, "order_timestamp", "DATE '2099-01-01'"), (9, "customer_id", "'nobody'"), (10, "promotion_id", "'PROMO-none'"),
    )),
    "order_items": (211, (
        (2, "order_id", "NULL"), (3, "product_id", "NULL"), (4, "quantity", "NULL"), (5, "unit_price", "NULL"), (6, "unit_cost", "NULL"),
        (7, "discount_rate", "NULL"), (8, "quantity", "0"), (9, "unit_price", "-1"), (10, "unit_cost", "0"), (11, "unit_cost", "unit_price + 1"),
        (12, "discount_rate", "1.5"), (13, "order_id", "'none'"), (14, "product_id", "'none'"),
    )),
    "returns": (53, (
        (1, "return_id", "NULL"), (2, "line_id", "NULL"), (3, "return_date", "NULL"), (4, "returned_quantity", "NULL"), (5, "reason", "NULL"),
        (6, "returned_quantity", "0"), (7, "reason", "'Lost'"), (8, "returned_quantity", "100000"), (9, "return_date", "DATE '1990-01-01'"),
        (10, "line_id", "'none'"), (11, "return_date", "DATE '2099-01-01'"), (12, "return_id", "'R-1'"),
    )),
    "promotions": (7, (
        (1, "discount_policy", "1.5"), (2, "end_date", "date_add(start_date, -10)"), (3, "promotion_type", "NULL"), (4, "start_date", "DATE '2099-01-01'"),
    )),
    "calendar_events": (397, ((1, "seasonal_event", "NULL"), (2, "seasonal_event", "'Monsoon'"))),
}


def damaged_batch(batch: SourceTables) -> SourceTables:
    """Every row of the batch, some with a defect: at least one for each rule on values, keys, pairs, parents and lookups."""
    changed = {}
    for table, (every, defects) in DEFECTS.items():
        df = batch[table]
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        cases: dict[str, str] = {}
        for place, column, value in defects:
            cases[column] = cases.get(column, "") + f" WHEN {SOURCE_ROW} % {every} = {place} THEN CAST({value} AS {kinds[column]})"
        for lost, column in (("orders", "order_id"), ("order_items", "line_id")):
            if lost == table:
                cases[column] = cases.get(column, "") + f" WHEN {SOURCE_ROW} = {LOST_KEY_ROW} THEN NULL"
        changed[table] = df.withColumns({c: F.expr(f"CASE{when} ELSE `{c}` END") for c, when in cases.items()})
    return batch.replace(**changed)
