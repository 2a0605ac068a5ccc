"""Propensity of churn on customer snapshots: baselines, a classifier, and how well their probabilities hold.

Snapshots are split by time. Training snapshots are those whose horizon ends before the first test cutoff, so no label of the training set
is decided by a day that the test set predicts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import ratio
from ledgerlake.operators.edges import exact_edges, part_of

RECENCY_PARTS, CALIBRATION_PARTS = 5, 10
#: Probabilities are compared as whole billionths.
FINE = 1_000_000_000
FEATURES = ("recency_days", "tenure_days", "order_count", "completed_order_count", "net_units", "net_value")


@dataclass(frozen=True)
class TimeSplit:
    train: DataFrame
    test: DataFrame


def split_by_time(snapshots: DataFrame, first_test: date, horizon_days: int) -> TimeSplit:
    """Labelled snapshots before and from ``first_test`` on; those whose horizon spans it belong to neither."""
    known = snapshots.where(F.col("churned").isNotNull())
    before = F.col("cutoff") <= F.lit(first_test - timedelta(days=horizon_days + 1))
    return TimeSplit(known.where(before), known.where(F.col("cutoff") >= F.lit(first_test)))


def _rate(train: DataFrame) -> Column:
    return train.agg(ratio(F.sum("churned"), F.count("*"))).scalar()


def majority_baseline(split: TimeSplit) -> DataFrame:
    """Every snapshot of the test set gets the churn rate of the training set."""
    return split.test.withColumn("probability", _rate(split.train))


def recency_baseline(split: TimeSplit, parts: int = RECENCY_PARTS) -> DataFrame:
    """The churn rate of the training snapshots in the same fifth of recency; fifths are those of the training set.

    A fifth without training snapshots, which ties can leave, has the rate of the whole training set.
    """
    edges = exact_edges(split.train, {"recency": F.col("recency_days")}, parts)["recency"]
    if not edges:
        return majority_baseline(split)
    part = part_of(F.col("recency_days"), edges)
    rates = split.train.groupBy(part.alias("_part")).agg(ratio(F.sum("churned"), F.count("*")).alias("_rate"))
    scored = split.test.withColumn("_part", part).join(rates, "_part", "left")
    return scored.withColumn("probability", F.coalesce("_rate", _rate(split.train))).drop("_part", "_rate")


def _numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES}).withColumn("_label", F.col("churned").cast("double"))


def fit_classifier(train: DataFrame) -> PipelineModel:
    """Logistic regression on scaled features, fitted over the whole training set."""
    steps = [
        VectorAssembler(inputCols=[f"_{c}" for c in FEATURES], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True),
        LogisticRegression(featuresCol="_features", labelCol="_label", probabilityCol="_p", regParam=0.001, maxIter=50),
    ]
    return Pipeline(stages=steps).fit(_numbers(train))


def classify(model: PipelineModel, snapshots: DataFrame) -> DataFrame:
    return model.transform(_numbers(snapshots)).select(*snapshots.columns, F.get(vector_to_array("_p"), F.lit(1)).alias("probability"))


def brier(scored: DataFrame, *by: str) -> DataFrame:
    """Snapshots, churn rate, mean probability and Brier score (mean squared distance to the label), by group or over all."""
    off = F.col("probability") - F.col("churned")
    return scored.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.round(F.avg("churned"), 9).alias("churn_rate"),
        F.round(F.avg("probability"), 9).alias("mean_probability"),
        F.round(F.avg(off * off), 9).alias("brier"),
    )


def calibration(scored: DataFrame, parts: int = CALIBRATION_PARTS) -> DataFrame:
    """Mean probability beside the churn rate in each tenth of the probabilities; equal probabilities are never parted."""
    fine = F.round(F.col("probability") * FINE).cast("bigint")
    edges = exact_edges(scored, {"p": fine}, parts)["p"]
    return brier(scored.withColumn("part", part_of(fine, edges).cast("bigint") if edges else F.lit(1).cast("bigint")), "part")


def compare_models(split: TimeSplit, customers: DataFrame) -> DataFrame:
    """Brier scores of both baselines, over all test snapshots (segment ``all``) and by customer segment."""
    segments = customers.select("customer_id", "segment")
    parts = []
    for name, scored in (("majority", majority_baseline(split)), ("recency", recency_baseline(split))):
        named = scored.join(segments, "customer_id")
        both = named.withColumn("segment", F.explode(F.array(F.lit("all"), F.col("segment"))))
        parts.append(brier(both, "segment").withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1]).select("model", "segment", "n", "churn_rate", "mean_probability", "brier")
