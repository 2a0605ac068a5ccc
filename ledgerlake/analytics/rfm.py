"""Recency, frequency and monetary value of customers, scored by exact quintiles of the whole table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.edges import exact_edges, part_of

SCORES = 5
UNSCORED, LATER = "No completed purchase", "After analysis date"


def segment(r: Column, f: Column, m: Column) -> Column:
    """The first rule that fits."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champion")
        .when((r >= 3) & (f >= 4), "Loyal")
        .when((r >= 4) & (f <= 2), "Recent")
        .when((r <= 2) & (f >= 3), "At risk")
        .when((r <= 2) & (f <= 2), "Dormant")
        .otherwise("Regular")
    )


def build_rfm(customers: DataFrame, analysis_date: date) -> DataFrame:
    """One row per customer of ``mart_customer_360``.

    Frequency counts completed orders, monetary value is net of returns. Scores run from 1 to 5, 5 being the most recent, most
    frequent or most valuable; equal values get equal scores, the lower one where they lie on an edge (for recency the better one).
    Customers whose orders were all returned, or who have none, get no scores, nor do those who bought after ``analysis_date``; neither
    takes part in the edges.
    """
    day = F.lit(analysis_date)
    bought, later = F.col("completed_order_count") > 0, F.col("last_purchase_date") > day
    scored = bought & ~later
    recency = F.when(scored, F.datediff(day, "last_purchase_date").cast("bigint"))
    base = customers.select(
        "customer_id",
        "last_purchase_date",
        recency.alias("recency_days"),
        F.col("completed_order_count").alias("frequency_orders"),
        F.col("return_adjusted_value").alias("monetary_value"),
    )
    is_scored = F.col("recency_days").isNotNull()
    cents = F.col("monetary_value") * 100
    measures = {"r": F.col("recency_days"), "f": F.col("frequency_orders"), "m": cents}
    edges = exact_edges(base.where(is_scored), measures, SCORES)
    part = {name: part_of(c.cast("bigint"), edges[name]) for name, c in measures.items()}
    score = {"r": SCORES + 1 - part["r"], "f": part["f"], "m": part["m"]}
    with_scores = base.withColumns({f"{name}_score": F.when(is_scored, c) for name, c in score.items()})
    named = segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    other = F.when(F.col("frequency_orders") > 0, LATER).otherwise(UNSCORED)
    return with_scores.withColumn("rfm_segment", F.when(is_scored, named).otherwise(other))
