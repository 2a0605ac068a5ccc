"""Features, folds, baselines and errors for weekly forecasts by category, on ``mart_forecasting_base``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import ratio
from ledgerlake.operators.slices import SLICE_ROWS, windowed

LAGS, WINDOWS = (1, 2, 4, 52), (4, 13)
MIN_TRAIN, HORIZON, STEP = 104, 4, 4
SEASON = 52
#: What a mart row says about its own week only once the week is over; used with a lag of one week.
_LATE = (
    "average_unit_price", "effective_discount_rate", "online_unit_share", "store_unit_share", "marketplace_unit_share",
)


def weeks_between(first: Column, last: Column) -> Column:
    return (F.datediff(last, first) / 7).cast("bigint")


def with_period(series: DataFrame) -> DataFrame:
    """Add ``period``: weeks since the first week of the table, 0 for that one."""
    first = series.agg(F.min("week_start")).scalar()
    return series.withColumn("period", weeks_between(first, F.col("week_start")))


# --- features -------------------------------------------------------------------------------------


def _rolling(target: str, rows: int) -> dict[str, Callable]:
    """Mean and sample deviation of the rows before, NULL until there are enough; from exact sums, so engines agree."""
    x = F.col(target).cast("decimal(38,0)")

    def over(window, value):
        return F.sum(value).over(window.rowsBetween(-rows, -1))

    def full(window):
        return F.count(F.lit(1)).over(window.rowsBetween(-rows, -1)) == rows

    def deviation(window):
        spread = rows * over(window, x * x) - over(window, x) * over(window, x)
        return F.when(full(window), F.sqrt(spread.cast("double") / (rows * (rows - 1))))

    return {
        f"rolling_mean_{rows}": lambda w: F.when(full(w), over(w, x).cast("double") / rows),
        f"rolling_std_{rows}": deviation,
    }


def temporal_features(base: DataFrame, target: str = "ordered_quantity", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per category and week with what is known before the week begins, and the target of the week itself.

    Lags and rolling values are of earlier weeks only: shifted first, rolled then. Price, discount, channel mix and promotion share are
    those of the week before. Calendar columns are known ahead. A column is NULL where the series is too short. The mart has a row
    for every week, so weeks since the first one are positions without gaps.
    """
    columns: dict[str, Callable] = {f"lag_{k}": lambda w, k=k: F.lag(target, k).over(w) for k in LAGS}
    for rows in WINDOWS:
        columns |= _rolling(target, rows)
    columns |= {f"{c}_lag_1": lambda w, c=c: F.lag(c, 1).over(w) for c in _LATE}
    promoted = ratio(F.col("promoted_order_count"), F.col("order_count"))
    columns["promoted_share_lag_1"] = lambda w: F.lag(promoted, 1).over(w)
    columns["price_change"] = lambda w: ratio(F.lag("average_unit_price", 1).over(w), F.lag("average_unit_price", 2).over(w)) - 1
    halo = max(*LAGS, *WINDOWS)
    made = windowed(with_period(base), ["category"], "period", halo, columns, slice_rows)
    return made.select(
        "category",
        "week_start",
        F.col(target).alias("target"),
        *columns,
        F.month("week_start").cast("bigint").alias("month_number"),
        F.weekofyear("week_start").cast("bigint").alias("week_of_year"),
        "holiday_days",
        "campaign_days",
    )


# --- folds ----------------------------------------------------------------------------------------


def rolling_origin_splits(dates: DataFrame, min_train: int = MIN_TRAIN, horizon: int = HORIZON, step: int = STEP) -> DataFrame:
    """One row per fold, from a table with ``week_start``; a week without a row between others is a week all the same.

    The first fold trains on ``min_train`` weeks, each later one on ``step`` weeks more; the ``horizon`` weeks after are its test. A fold
    whose test would leave the table does not exist; a table that is too short has none.
    """
    if min(min_train, horizon, step) < 1:
        raise ValueError("min_train, horizon and step are 1 or more")
    span = dates.agg(F.min("week_start").alias("first"), F.max("week_start").alias("last"))
    last_fold = F.floor((weeks_between(F.col("first"), F.col("last")) + 1 - min_train - horizon) / step)
    folds = span.where(last_fold >= 0).select("first", F.explode(F.sequence(F.lit(0).cast("bigint"), last_fold)).alias("fold"))
    train = min_train + F.col("fold") * step
    week = lambda n: F.date_add("first", (7 * n).cast("int"))
    return folds.select(
        "fold",
        F.col("first").alias("train_start"),
        week(train - 1).alias("train_end"),
        week(train).alias("test_start"),
        week(train + horizon - 1).alias("test_end"),
        train.alias("train_weeks"),
    )


def fold_membership(series: DataFrame, min_train: int = MIN_TRAIN, horizon: int = HORIZON, step: int = STEP) -> DataFrame:
    """Add to each row its ``period``, the first fold that trains on it, and the first and last fold that test on it.

    Training sets grow, so a row is in those of all folds from its first one on: one number stands for all, and no row is copied.
    NULL where there is no such fold.
    """
    last = series.agg(weeks_between(F.min("week_start"), F.max("week_start"))).scalar()
    last_fold = F.floor((last + 1 - min_train - horizon) / step)
    p = F.col("period")
    first_train = F.greatest(F.lit(0), F.ceil((p - min_train + 1) / step))
    first_test = F.greatest(F.lit(0), F.ceil((p - min_train - horizon + 1) / step))
    last_test = F.least(last_fold, F.floor((p - min_train) / step))
    tested = first_test <= last_test
    return with_period(series).withColumns(
        {
            "first_train_fold": F.when(first_train <= last_fold, first_train),
            "first_test_fold": F.when(tested, first_test),
            "last_test_fold": F.when(tested, last_test),
        }
    )


# --- baselines ------------------------------------------------------------------------------------


def last_known(series: DataFrame, value: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """As of each period the last value that is not NULL: category, period and ``known``; series without gaps in their periods.

    Within a slice by a running window; the last value of the slices before, one row per slice, is brought to those rows that have none.
    """
    part = F.floor(F.col("period") / slice_rows)
    cut = series.select("category", "period", F.col(value).alias("value"), part.alias("part"))
    local = Window.partitionBy("category", "part").orderBy("period")
    found = cut.withColumn("here", F.last("value", ignorenulls=True).over(local))
    ends = cut.where(F.col("value").isNotNull()).groupBy("category", "part").agg(F.max_by("value", "period").alias("end"))
    parts = cut.select("category", "part").distinct().join(ends, ["category", "part"], "left")
    earlier = Window.partitionBy("category").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("category", "part", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    joined = found.join(carried, ["category", "part"])
    return joined.select("category", "period", F.coalesce("here", "carried").alias("known"))


def baseline_forecasts(
    base: DataFrame, target: str = "ordered_quantity", min_train: int = MIN_TRAIN, horizon: int = HORIZON, step: int = STEP
) -> DataFrame:
    """Each tested week of each fold with the forecasts of two baselines: fold, category, horizon, actual, model, forecast.

    ``last_value`` is the last known value at the origin, the last week of the training set; ``seasonal_naive`` the value 52 weeks before the
    tested week, or the nearest earlier multiple of 52 where that week is not yet known at the origin. Forecasts that would reach back before the
    table are left out. Only tested rows are copied, once for each fold that tests them.
    """
    rows = fold_membership(base.select("category", "week_start", target), min_train, horizon, step)
    tested = rows.where(F.col("first_test_fold").isNotNull()).select(
        "category", "week_start", "period", F.col(target).alias("actual"), F.explode(F.sequence("first_test_fold", "last_test_fold")).alias("fold")
    )
    origin = min_train + F.col("fold") * step - 1
    ahead = tested.withColumn("origin", origin).withColumn("horizon", F.col("period") - F.col("origin"))
    seasons = F.ceil(F.col("horizon") / SEASON) * SEASON
    sources = F.array(
        F.struct(F.lit("last_value").alias("model"), F.col("origin").alias("source")),
        F.struct(F.lit("seasonal_naive").alias("model"), (F.col("period") - seasons).alias("source")),
    )
    asked = ahead.withColumn("s", F.explode(sources)).select("*", "s.*").drop("s", "origin", "period")
    past = last_known(rows, target).withColumnRenamed("period", "source")
    return asked.join(past, ["category", "source"]).select(
        "fold", "category", "week_start", "horizon", "model", "actual", F.col("known").alias("forecast")
    )


def forecast_errors(forecasts: DataFrame) -> DataFrame:
    """MAE and sMAPE by model, horizon and category. sMAPE is the mean of 2|a - f| / (|a| + |f|), 0 where both are zero."""
    off = F.abs(F.col("actual") - F.col("forecast"))
    size = F.abs("actual") + F.abs("forecast")
    share = F.coalesce(ratio(2 * off, size), F.lit(0.0))
    known = forecasts.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    return known.groupBy("model", "horizon", "category").agg(
        F.count("*").alias("n"), ratio(F.sum(off), F.count("*")).alias("mae"), F.round(F.avg(share), 9).alias("smape")
    )
