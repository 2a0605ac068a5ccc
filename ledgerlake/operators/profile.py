"""Profile of a raw table: size, missing values, duplicates, value counts, quality rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.exprs import lookup, number_or_null, timestamp_or_null
from ledgerlake.operators.cleaning import CleaningRules
from ledgerlake.operators.groups import attach_group_value, lookup_where, running_counts, value_at
from ledgerlake.operators.groups import value_counts as count_values
from ledgerlake.schemas import FLAT_COLUMNS, SOURCE_ROW


def table_shape(df: DataFrame, key: str) -> DataFrame:
    columns = [c for c in df.columns if c != SOURCE_ROW]
    return df.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("unique_keys")).withColumn(
        "column_count", F.lit(len(columns)).cast("bigint")
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with their number: one scan for all columns."""
    columns = [c for c in df.columns if c != SOURCE_ROW]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "missing").where(F.col("missing") > 0)


def duplicated_rows(df: DataFrame) -> DataFrame:
    """All copies of rows that occur more than once, including the first; NULLs count as equal.

    Copies are counted map-side by all their columns. Those that repeat are brought to the rows by a 128-bit digest, the very frequent ones by
    broadcast, and compared there column by column, so a digest shared by chance adds no row.
    """
    columns = [c for c in df.columns if c != SOURCE_ROW]
    cells = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    # A second hash of other content: the first one and the cells in reverse.
    digest = F.concat_ws(":", F.xxhash64(*cells).cast("string"), F.xxhash64(F.xxhash64(*cells), *reversed(cells)).cast("string"))
    row = F.struct(*columns)
    repeats = df.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    by_digest = repeats.groupBy(digest.alias("_row")).agg(F.collect_list(row).alias("_rows"), F.sum("_n").alias("_n"))
    known = attach_group_value(df.withColumn("_row", digest), "_row", by_digest, "_rows", "_n")
    return known.where(F.exists("_rows", lambda r: r.eqNullSafe(row))).select(*df.columns)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def numeric_summary(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each numeric column.

    A quartile interpolates between the values at two ranks of the ordered distinct values."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != SOURCE_ROW]
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))  # noqa: E731  NaN counts as missing
    tall = df.select([number(c).alias(c) for c in numeric]).unpivot([], numeric, "column_name", "value")
    placed = running_counts(count_values(tall, "column_name", "value"), "column_name", "value")

    def quantile(fourths: int):
        # Zero-based position fourths * (rows - 1) / 4, split into a rank and a remainder.
        position = F.lit(fourths) * (F.col("_all") - 1)
        low = value_at(F.floor(position / 4) + 1, "value")
        high = value_at(F.ceil(position / 4) + 1, "value")
        return low + (high - low) * (F.max(F.pmod(position, F.lit(4))) / 4.0)

    moments = tall.groupBy("column_name").agg(
        F.count("value").alias("value_count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    spread = placed.groupBy("column_name").agg(
        F.min("value").alias("min"),
        quantile(1).alias("q25"),
        quantile(2).alias("q50"),
        quantile(3).alias("q75"),
        F.max("value").alias("max"),
    )
    return moments.join(spread, "column_name")


def column_conformance(df: DataFrame, expected: Sequence[str] = FLAT_COLUMNS) -> dict[str, list[str]]:
    """Missing and unexpected columns; looks at the schema only."""
    actual = [c for c in df.columns if c != SOURCE_ROW]
    return {
        "missing": [c for c in expected if c not in actual],
        "unexpected": [c for c in actual if c not in expected],
    }


def quality_summary(df: DataFrame, rules: CleaningRules, cities: Sequence[str] | DataFrame) -> DataFrame:
    """Twelve rules counted one by one; a row may break several. Nothing is changed."""
    if isinstance(rules.categories, DataFrame):
        judged = lookup_where(df, F.lit(True), "Product", rules.categories, "Category", "_approved")
    else:
        judged = df.withColumn("_approved", lookup(rules.categories, F.col("Product")))
    if isinstance(cities, DataFrame):
        known = cities.select("City", F.lit(True).alias("_known"))
        judged = lookup_where(judged, F.lit(True), "City", known, "_known", "_known_city")
        strange_city = F.col("City").isNotNull() & F.col("_known_city").isNull()
    else:
        strange_city = F.col("City").isNotNull() & ~F.col("City").isin(*cities)
    quantity = number_or_null(F.col("Quantity"))
    when = timestamp_or_null(F.col("Order_Date"))
    in_scope = F.year(when).between(rules.first_year, rules.last_year)
    local = judged.agg(
        F.count_if(F.col("City").isNull()).alias("Missing city values"),
        F.count_if(F.col("Payment_Method").isNull()).alias("Missing payment methods"),
        F.count_if(strange_city).alias("Non-standard city values"),
        F.count_if(quantity.isNull()).alias("Non-numeric quantities"),
        F.count_if(quantity <= 0).alias("Zero or negative quantities"),
        F.count_if(F.col("Unit_Price_USD") <= 0).alias("Zero or negative unit prices"),
        F.count_if(~F.coalesce(F.col("Discount_Rate").between(0, 1), F.lit(False))).alias("Discount rates outside 0-1"),
        F.count_if(when.isNull()).alias("Unparseable order dates"),
        F.count_if(~in_scope).alias("Dates outside scope"),
        F.count_if(F.coalesce(F.col("Category") != F.col("_approved"), F.lit(True))).alias("Product/category mismatches"),
    )

    def extra_copies(keys: Sequence[str], name: str) -> DataFrame:
        surplus = df.groupBy(*keys).agg((F.count("*") - 1).alias("n"))
        total = surplus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("Issue_Count"))
        return total.select(F.lit(name).alias("Quality_Check"), "Issue_Count")

    return (
        extra_copies(FLAT_COLUMNS, "Exact duplicate rows")
        .unionByName(extra_copies(["Order_Line_ID"], "Duplicate Order_Line_ID values"))
        .unionByName(local.unpivot([], local.columns, "Quality_Check", "Issue_Count"))
    )
