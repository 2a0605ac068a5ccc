"""Group-wise operators that stay safe when one group holds a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.bitmaps import maybe_in
from ledgerlake.operators.slices import numbered, running_sums
from ledgerlake.schemas import SOURCE_ROW
from ledgerlake.session import stored

HOT_GROUP_ROWS = 1_000_000
MAX_HOT_GROUPS = 50_000
#: More than hot groups at most, so that a bucket of usual groups stays below the limit.
HOT_BUCKETS = 1 << 17
NULL_SPREAD = 1024


def _hot_limit(df: DataFrame, rows: int) -> Column:
    """Rows above which a group is hot; a plain count, which needs no shuffle."""
    return F.greatest(F.lit(rows), F.ceil(df.agg(F.count("*")).scalar() / MAX_HOT_GROUPS))


def hot_groups(df: DataFrame, key: str, order: str, rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Groups too large for one task, with the rows that a slice of them may have: ``key, slice_rows``.

    A group is hot above ``rows`` rows, or above 1/50,000 of the table if that is more, so there
    are at most 50,000 of them whatever the table's size, and 100,000 slices in all. Rows are counted by bucket first; only groups of buckets
    that hold more rows than that are counted one by one.
    """
    limit = _hot_limit(df, rows).cast("bigint")
    bucket = F.pmod(F.xxhash64(key), F.lit(HOT_BUCKETS))
    full = df.where(F.col(key).isNotNull()).groupBy(bucket.alias("_bucket")).agg(F.count(order).alias("n")).where(F.col("n") > limit)
    sizes = df.join(F.broadcast(full.select("_bucket")), bucket == F.col("_bucket"), "left_semi").groupBy(key).agg(F.count(order).alias("n"))
    return sizes.where(F.col(key).isNotNull() & (F.col("n") > limit)).select(key, limit.alias("slice_rows"))


def in_slices(df: DataFrame, key: str, order: str, hot: DataFrame) -> DataFrame:
    """The rows of the groups in ``hot``, with ``_slice``: slices of a group have ``slice_rows`` rows each, the last one fewer."""
    sizes = F.broadcast(hot.select(F.col(key).alias("_hot_key"), "slice_rows"))
    found = numbered(df.join(sizes, F.col(key) == F.col("_hot_key")).drop("_hot_key"), [key], order, "_at")
    return found.withColumn("_slice", F.floor(F.col("_at") / F.col("slice_rows"))).drop("_at", "slice_rows")


def _fills(rows: DataFrame, key: str, order: str, names: list[str], *slice_key: str) -> DataFrame:
    """For each row the nearest earlier value of its group or slice, else the first one."""
    in_order = Window.partitionBy(key, *slice_key).orderBy(order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns(
        {f"_back_{n}": F.last(f"_v_{n}", ignorenulls=True).over(so_far) for n in names}
        | {f"_first_{n}": F.first(f"_v_{n}", ignorenulls=True).over(whole) for n in names}
    )


def _fills_of_slices(rows: DataFrame, key: str, order: str, names: list[str]) -> DataFrame:
    """The same for groups in slices; what comes from other slices comes from one summary row per slice."""
    known = lambda which, n: F.expr(
        f"{which}_by(`_v_{n}`, `{order}`) filter (where `_v_{n}` is not null)"
    )
    summaries = rows.groupBy(F.col(key).alias("_hot_key"), F.col("_slice").alias("_hot_slice")).agg(
        *[known("min", n).alias(f"_lo_{n}") for n in names], *[known("max", n).alias(f"_hi_{n}") for n in names]
    )
    slices = Window.partitionBy("_hot_key").orderBy("_hot_slice")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    every = slices.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = summaries.select(
        "_hot_key",
        "_hot_slice",
        *[F.last(f"_hi_{n}", ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in names],
        *[F.first(f"_lo_{n}", ignorenulls=True).over(every).alias(f"_head_{n}") for n in names],
    )
    same_slice = (F.col(key) == F.col("_hot_key")) & (F.col("_slice") == F.col("_hot_slice"))
    local = _fills(rows, key, order, names, "_slice").join(F.broadcast(carried), same_slice)
    # Beyond its own slice a row takes from earlier ones first, then from its own, then from any.
    return local.withColumns(
        {f"_first_{n}": F.coalesce(f"_carry_{n}", f"_first_{n}", f"_head_{n}") for n in names}
    )


def fill_from_group(df: DataFrame, key: str, order: str, columns: dict[str, Column], hot: DataFrame) -> DataFrame:
    """Fill NULLs from the nearest earlier row of the group, else from the nearest later one.

    ``columns`` maps each output column to the value to fill; ``order`` tells the rows of a group apart. Rows that lack nothing
    stay where they are. Of groups in which a row lacks something, and of the few others that a filter of their keys lets through, only the
    key, the order and the values are sorted; if nothing precedes a row, the nearest later value is the first value of the whole group, so one sort serves both directions. The groups in ``hot`` are cut
    into slices of equal numbers of rows. ``hot_groups`` bounds their number by a constant, which is why they are broadcast. Rows
    without a group keep their own values.
    """
    names = list(columns)
    values = df.withColumns({f"_v_{n}": c for n, c in columns.items()})
    lacks = reduce(Column.__or__, [F.col(f"_v_{n}").isNull() for n in names])
    asks = lacks & F.col(key).isNotNull()
    kept = [c for c in df.columns if c not in columns]
    narrow = values.select(key, order, *[f"_v_{n}" for n in names])
    hot = stored(hot)
    asking = stored(narrow.where(asks).select(key).distinct())
    near = maybe_in(narrow.where(F.col(key).isNotNull()), key, asking)
    cold = near.join(F.broadcast(hot.select(F.col(key).alias("_hot_key"))), F.col(key) == F.col("_hot_key"), "left_anti")
    found = _fills(cold, key, order, names)
    picked = lambda df: df.where(lacks).select(
        F.col(key).alias("_of"), F.col(order).alias("_at"), *[F.coalesce(f"_back_{n}", f"_first_{n}").alias(f"_f_{n}") for n in names]
    )
    fills = picked(found)
    if not hot.isEmpty():
        fills = fills.unionByName(picked(_fills_of_slices(in_slices(narrow, key, order, hot), key, order, names)))
    complete = values.where(~asks).select(*kept, *[F.col(f"_v_{n}").alias(n) for n in names])
    filled = values.where(asks).join(fills, (F.col(key) == F.col("_of")) & (F.col(order) == F.col("_at")), "left")
    return complete.unionByName(filled.select(*kept, *[F.col(f"_f_{n}").alias(n) for n in names]))


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Number of rows ``_n`` per group and distinct value, NULL values left out."""
    return df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))


def running_counts(counts: DataFrame, key: str, value: str) -> DataFrame:
    """Add ``_upto``, the rows of the group with this or a smaller value, and ``_all``.

    Values are dealt out by ranges, cut where their numbers say; no task sees more than one range, however close together the
    values of a large group lie.
    """
    return running_sums(counts, [key], value, "_n", "_upto", "_all")


def value_at(rank: Column, value: str) -> Column:
    """Aggregate: the value at a 1-based rank, from ``running_counts``."""
    return F.min(F.when(F.col("_upto") >= rank, F.col(value)))


def exact_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """Interpolating median per group: columns ``key, median``. Equal values are counted first,
    map-side, so what is ordered are the distinct values."""
    placed = running_counts(value_counts(df, key, value), key, value)
    low = value_at(F.expr("(_all + 1) div 2"), value)
    high = value_at(F.expr("(_all + 2) div 2"), value)
    kind = df.schema[value].dataType.simpleString()
    return placed.groupBy(key).agg(((low + high) / 2).cast(kind).alias("median"))


def lookup_where(
    df: DataFrame, needed: Column, key: str, table: DataFrame, value: str, alias: str, spread: str = SOURCE_ROW
) -> DataFrame:
    """Left lookup of ``table[value]`` by the text ``key``, for the rows that need it.

    Join keys are ``0|<key>``. Rows that need no lookup get ``<1..1024>|`` by the hash of the
    ``spread`` column, which never matches: should the table be too large to broadcast, they
    scatter over all partitions instead of piling up on NULL or on popular keys.
    """
    elsewhere = F.expr(f"concat(pmod(xxhash64(`{spread}`), {NULL_SPREAD}) + 1, '|')")
    own = F.when(needed & F.col(key).isNotNull(), F.expr(f"concat('0|', `{key}`)")).otherwise(elsewhere)
    side = table.selectExpr(f"concat('0|', `{key}`) AS _wanted", f"`{value}` AS `{alias}`")
    return df.withColumn("_wanted", own).join(side, "_wanted", "left").drop("_wanted")


def attach_group_value(
    df: DataFrame,
    key: str,
    groups: DataFrame,
    value: str,
    size: str,
    spread: str = SOURCE_ROW,
    rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Bring a value computed per group back to the group's rows.

    ``groups`` has one row per key with the group's ``size``. Spark splits a hot join key only
    between two plain shuffles, not against an aggregate whose partitioning is reused; so the
    values of hot groups, at most 50,000 of them, are broadcast, and their rows are kept out of
    the shuffled join for the others.
    """
    is_hot = F.col(size) > _hot_limit(df, rows)
    hot = groups.where(is_hot).selectExpr(f"`{key}` AS _hot_key", f"`{value}` AS _hot_value")
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    cold = groups.where(~is_hot).select(key, value)
    looked_up = lookup_where(marked, F.expr("_hot_key IS NULL"), key, cold, value, "_cold_value", spread)
    found = F.expr("if(_hot_key IS NOT NULL, _hot_value, _cold_value)")
    return looked_up.withColumn(value, found).drop("_hot_key", "_hot_value", "_cold_value")
