"""Retention of customers by the month of their first completed purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import month_diff, ratio
from ledgerlake.session import stored

#: Ages, in months, that the matrix has columns for.
MATRIX_AGES = 25


def retention(purchases: DataFrame) -> DataFrame:
    """Long form of ``mart_cohort_base``, or of its ``purchase_months``: every cohort at every age that has happened.

    A month of a cohort without purchases is a row with 0; months after the last month of the table have no row. At age 0 the whole
    cohort is active, so retention starts at 1. Fully returned orders are not in the mart, and play no part.
    """
    cohort, age = "acquisition_cohort_month", "months_since_acquisition"
    # Read three times: at most one row for each two months, from a shuffle of all customers' months.
    active = stored(purchases.groupBy("customer_id", cohort, age).agg(F.lit(1)).groupBy(cohort, age).agg(F.count("*").alias("active")))
    last = active.select(F.max(F.add_months(cohort, F.col(age).cast("int"))).alias("m")).scalar()
    size = F.coalesce(F.sum(F.when(F.col(age) == 0, F.col("active"))), F.lit(0)).alias("cohort_size")
    ages = F.explode(F.sequence(F.lit(0).cast("bigint"), month_diff(F.col("last"), F.col(cohort)))).alias(age)
    grid = active.groupBy(cohort).agg(size).withColumn("last", last).select(cohort, "cohort_size", ages)
    filled = grid.join(active, [cohort, age], "left").withColumn("active", F.coalesce("active", F.lit(0)))
    return filled.select(
        F.col(cohort).alias("cohort_month"),
        F.col(age).alias("age_months"),
        "cohort_size",
        F.col("active").alias("active_customers"),
        ratio(F.col("active"), F.col("cohort_size")).alias("retention"),
    )


def retention_matrix(long: DataFrame, ages: int = MATRIX_AGES) -> DataFrame:
    """One row per cohort, one column per age; NULL where a month has not happened yet. The columns do not depend on the data."""
    cells = [F.max(F.when(F.col("age_months") == k, F.col("retention"))).alias(f"age_{k:02d}") for k in range(ages)]
    return long.groupBy("cohort_month", "cohort_size").agg(*cells)
