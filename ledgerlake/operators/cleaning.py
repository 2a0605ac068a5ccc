"""Audited cleaning of the flat order-line sheet.

The steps run in a fixed order, and a later step sees only rows that earlier steps kept.
Instead of filtering step by step, rows carry flags; the cleaned sheet is a filter over the
flags and the log a single aggregate over them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import lookup, number_or_null, strip, timestamp_or_null, title_case
from ledgerlake.operators.bitmaps import parted
from ledgerlake.operators.contracts import repeated_keys, short_hash
from ledgerlake.operators.groups import HOT_GROUP_ROWS, exact_median, fill_from_group, hot_groups, lookup_where
from ledgerlake.schemas import FLAT_COLUMNS, PAYMENT_METHODS, PRODUCT_CATEGORIES, SOURCE_ROW
from ledgerlake.session import stored

UNKNOWN = "Unknown"
# Sheet prices and rates keep twelve places; only money is rounded.
PRICE = "decimal(24,12)"
SHEET_RATE = "decimal(14,12)"
#: Bits of the filter of repeated lines for each of them: of the other lines, one in so many is counted whole with them.
HASH_FILTER_BITS = 32

# Writes a named intermediate table and returns it re-read; the default keeps the lazy plan.
Stage = Callable[[DataFrame, str], DataFrame]


def _no_stage(df: DataFrame, _name: str) -> DataFrame:
    return df


@dataclass(frozen=True)
class CleaningRules:
    """Vocabularies and the accepted years. ``categories`` is a dict, or a table of
    ``Product, Category`` when there are more products than a literal should hold."""

    categories: dict[str, str] | DataFrame = field(default_factory=lambda: dict(PRODUCT_CATEGORIES))
    payment_methods: dict[str, str] = field(default_factory=lambda: dict(PAYMENT_METHODS))
    first_year: int = 2025
    last_year: int = 2025
    hot_rows: int = HOT_GROUP_ROWS


def drop_exact_duplicates(raw: DataFrame) -> DataFrame:
    """One row per distinct line, at its first position, with the number of ``_copies``.

    Hashes of lines are counted first, and whole lines only where the hash repeats: a line that stands alone crosses no shuffle.
    Copies merge before the shuffle, so a line repeated very often stays cheap."""
    hashed = raw.select(*FLAT_COLUMNS, SOURCE_ROW, short_hash(raw.count(), *FLAT_COLUMNS).alias("_hash"))
    repeated = stored(repeated_keys(hashed, "_hash").select("_hash"))
    maybe, alone = parted(hashed, "_hash", repeated, bits_each=HASH_FILTER_BITS)
    merged = maybe.groupBy(*FLAT_COLUMNS).agg(F.min(SOURCE_ROW).alias(SOURCE_ROW), F.count("*").alias("_copies"))
    return merged.unionByName(alone.drop("_hash").withColumn("_copies", F.lit(1).cast("bigint")))


def standardize_text(df: DataFrame, rules: CleaningRules) -> DataFrame:
    spelled = lookup(rules.payment_methods, F.lower(strip(F.col("Payment_Method"))))
    return df.withColumns(
        {
            "Product": strip(F.col("Product")),
            "Category": strip(F.col("Category")),
            "City": title_case(strip(F.col("City"))),
            "Payment_Method": spelled,
        }
    )


def parse_values(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Typed values and one flag per row-local rule. A missing discount is out of range; a
    missing price is not 'zero or negative' and stays missing."""
    quantity = number_or_null(F.col("Quantity"))
    when = timestamp_or_null(F.col("Order_Date"))
    in_scope = F.year(when).between(rules.first_year, rules.last_year)
    return df.withColumns(
        {
            "_bad_quantity": quantity.isNull() | (quantity <= 0),
            "_bad_price": F.coalesce(F.col("Unit_Price_USD") <= 0, F.lit(False)),
            "_bad_discount": ~F.coalesce(F.col("Discount_Rate").between(0, 1), F.lit(False)),
            "_bad_date": ~F.coalesce(in_scope, F.lit(False)),
            "_date": F.when(in_scope, when),
            "Quantity": F.when(quantity > 0, quantity).cast("bigint"),
            "Unit_Price_USD": F.col("Unit_Price_USD").cast(PRICE),
        }
    )


def _reaches_dates() -> Column:
    """Rows still present when dates are checked."""
    return ~F.col("_bad_quantity") & ~F.col("_bad_discount")


def recover_order_values(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Take a missing city, payment method or date from another line of the same order.

    All three share one sort per order. Dates come only from lines that reach the date step."""
    filled = fill_from_group(
        df.withColumns({"_city_missing": F.col("City").isNull(), "_payment_missing": F.col("Payment_Method").isNull()}),
        "Order_ID",
        SOURCE_ROW,
        {
            "City": F.col("City"),
            "Payment_Method": F.col("Payment_Method"),
            "_date": F.when(_reaches_dates(), F.col("_date")),
        },
        hot,
    )
    return filled.withColumns(
        {
            "_city_unknown": F.col("City").isNull(),
            "_payment_unknown": F.col("Payment_Method").isNull(),
            "City": F.coalesce("City", F.lit(UNKNOWN)),
            "Payment_Method": F.coalesce("Payment_Method", F.lit(UNKNOWN)),
            "Order_Date": F.col("_date"),
        }
    ).drop("_date")


def price_medians(df: DataFrame) -> DataFrame:
    """Median valid price per product over rows with a valid quantity."""
    valid = df.where(~F.col("_bad_quantity") & ~F.col("_bad_price"))
    return exact_median(valid.select("Product", "Unit_Price_USD"), "Product", "Unit_Price_USD")


def repair_prices(df: DataFrame, medians: DataFrame) -> DataFrame:
    looked_up = lookup_where(df, F.col("_bad_price"), "Product", medians, "median", "_median")
    price = F.when(F.col("_bad_price"), F.col("_median")).otherwise(F.col("Unit_Price_USD"))
    return looked_up.withColumn("Unit_Price_USD", price).drop("_median")


def correct_categories(df: DataFrame, rules: CleaningRules) -> DataFrame:
    if isinstance(rules.categories, DataFrame):
        joined = lookup_where(df, F.lit(True), "Product", rules.categories, "Category", "_approved")
    else:
        joined = df.withColumn("_approved", lookup(rules.categories, F.col("Product")))
    mismatch = F.coalesce(F.col("Category") != F.col("_approved"), F.lit(False))
    return joined.withColumn("_bad_category", mismatch).withColumn("Category", F.col("_approved")).drop("_approved")


def parsed_sheet(raw: DataFrame, rules: CleaningRules) -> DataFrame:
    return parse_values(standardize_text(drop_exact_duplicates(raw), rules), rules)


def judge_rows(parsed: DataFrame, hot: DataFrame, medians: DataFrame, rules: CleaningRules) -> DataFrame:
    """Every distinct line with its cleaned values, its flags and ``_kept``."""
    judged = correct_categories(repair_prices(recover_order_values(parsed, hot), medians), rules)
    return judged.withColumn("_kept", _reaches_dates() & F.col("Order_Date").isNotNull())


def judged_sheet(raw: DataFrame, rules: CleaningRules, stage: Stage = _no_stage) -> DataFrame:
    """The whole cleaning. ``stage`` writes the tables that are used more than once, which also
    lets Spark size the median table before it chooses how to join it."""
    parsed = stage(parsed_sheet(raw, rules), "parsed")
    medians = stage(price_medians(parsed), "medians")
    hot = hot_groups(raw, "Order_ID", SOURCE_ROW, rules.hot_rows)
    return stage(judge_rows(parsed, hot, medians, rules), "judged")


def cleaned_rows(judged: DataFrame) -> DataFrame:
    return judged.where("_kept").select(*FLAT_COLUMNS, SOURCE_ROW)


def cleaning_log(judged: DataFrame) -> DataFrame:
    """Eight rows: step, rows affected, decision."""
    n = lambda test: F.count_if(test)
    flag = F.col
    counts = judged.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("dup"),
        n(flag("_city_missing")).alias("city"),
        n(flag("_city_unknown")).alias("city_unknown"),
        n(flag("_payment_missing")).alias("payment"),
        n(flag("_payment_unknown")).alias("payment_unknown"),
        n(flag("_bad_quantity")).alias("quantity"),
        n(~flag("_bad_quantity") & flag("_bad_price")).alias("price"),
        n(~flag("_bad_quantity") & flag("_bad_discount")).alias("discount"),
        n(_reaches_dates() & flag("_bad_date")).alias("date"),
        n(_reaches_dates() & flag("Order_Date").isNull()).alias("date_lost"),
        n(flag("_kept") & flag("_bad_category")).alias("category"),
    )

    def recovered(total: str, lost: str, before: str, after: str) -> Column:
        return F.format_string(before + "%d" + after + "%d", F.col(total) - F.col(lost), F.col(lost))

    label = lambda total: recovered(total, f"{total}_unknown", "Recovered ", " from the same order; labeled ")
    dates = recovered("date", "date_lost", "Recovered ", " from the same order; removed ")
    # The wording of the log.
    steps = (
        ("Remove exact duplicates", "dup", F.lit("Removed completely identical rows")),
        ("Handle missing City", "city", F.concat(label("city"), F.lit(" as Unknown"))),
        ("Handle missing Payment_Method", "payment", F.concat(label("payment"), F.lit(" as Unknown"))),
        ("Validate quantity", "quantity", F.lit("Removed rows with non-numeric, zero, or negative quantity")),
        ("Repair unit prices", "price", F.lit("Replaced with median valid price for the same product")),
        ("Validate discount rates", "discount", F.lit("Removed rows with discount rates outside 0-1")),
        ("Validate order dates", "date", F.concat(dates, F.lit(" unrecoverable rows"))),
        ("Correct product categories", "category", F.lit("Replaced with the approved category for each product")),
    )
    rows = F.array(
        *[
            F.struct(F.lit(step).alias("Step"), F.col(c).alias("Rows_Affected"), text.alias("Decision"))
            for step, c, text in steps
        ]
    )
    return counts.select(F.inline(rows))


def postconditions(clean: DataFrame, rules: CleaningRules) -> DataFrame:
    """Violations per guarantee of the cleaned sheet: eight rows, all zero when it is sound."""
    if isinstance(rules.categories, DataFrame):
        judged = lookup_where(clean, F.lit(True), "Product", rules.categories, "Category", "_approved")
    else:
        judged = clean.withColumn("_approved", lookup(rules.categories, F.col("Product")))
    has_null = F.greatest(*[F.col(c).isNull() for c in FLAT_COLUMNS])
    year = F.year("Order_Date")
    local = judged.agg(
        F.count_if(has_null).alias("Missing values remain"),
        F.count_if(F.col("Quantity") <= 0).alias("Invalid quantities remain"),
        F.count_if(F.col("Unit_Price_USD") <= 0).alias("Invalid prices remain"),
        F.count_if(~F.col("Discount_Rate").between(0, 1)).alias("Invalid discounts remain"),
        F.count_if(~year.between(rules.first_year, rules.last_year)).alias("Invalid dates remain"),
        F.count_if(F.coalesce(F.col("Category") != F.col("_approved"), F.lit(True))).alias("Product/category mismatches remain"),
    )
    rows = clean.groupBy(*FLAT_COLUMNS).agg((F.count("*") - 1).alias("n"))
    lines = clean.groupBy("Order_Line_ID").agg((F.count("*") - 1).alias("n"))
    parts = [
        rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit("Exact duplicates remain").alias("rule"), "violations"),
        lines.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit("Line IDs are duplicated").alias("rule"), "violations"),
        local.unpivot([], local.columns, "rule", "violations"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
