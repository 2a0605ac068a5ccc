"""Positions of rows in their group, and windows over long groups, without a task that holds a whole group.

Rows are dealt out by ranges of (group, order): a large group lies in many ranges, whatever its values are, and the rows
before a range are known from one sum per range and group. Positions cut a group into slices of equal numbers of rows.
``windowed`` then runs window functions slice by slice, each with a halo of rows from the slices before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlake.session import stored

#: Rows of a slice, besides its halo.
SLICE_ROWS = 100_000


def _in_ranges(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows in ranges of (group, order), written: ``_range``, and ``_place``, which ascends within it."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *keys, order).sortWithinPartitions(*keys, order)
    return stored(dealt.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}))


def _with_begins(kept: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """Add to each row what its group has before its range (``_before``) and as a whole (``_whole``), and ``_first``, its group's first
    place in the range. There is one such row per range, and one more for each group that begins in it."""
    sizes = kept.groupBy(*keys, "_range").agg(F.sum(amount).alias("_n"), F.min("_place").alias("_first"))
    by_range = Window.partitionBy(*keys).orderBy("_range")
    before = F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    own = {k: f"_own_{i}" for i, k in enumerate(keys)}
    begins = sizes.select(
        *[F.col(k).alias(o) for k, o in own.items()], F.col("_range").alias("_in"), "_first",
        F.coalesce(before, F.lit(0)).alias("_before"), whole.alias("_whole"),
    )
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()] + [F.col("_range") == F.col("_in")]
    return kept.join(begins, same)


def numbered(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Add ``name``: 0 for the first row of its group in this order, 1 for the next, and so on; rows of equal order in any order.

    Rows of equal group and order meet in one range, so order them by something that tells most rows apart.
    """
    placed = _with_begins(_in_ranges(df, keys, order), keys, F.lit(1))
    return placed.select(*df.columns, (F.col("_before") + F.col("_place") - F.col("_first")).alias(name))


def running_sums(df: DataFrame, keys: list[str], order: str, amount: str, upto: str, whole: str) -> DataFrame:
    """Add ``upto``, the sum of ``amount`` over this row and those before it in its group, and ``whole``, that of the group."""
    placed = _with_begins(_in_ranges(df, keys, order), keys, F.col(amount))
    here = Window.partitionBy(*keys, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(*df.columns, (F.col("_before") + F.sum(amount).over(here)).alias(upto), F.col("_whole").alias(whole))


def windowed(
    df: DataFrame,
    keys: list[str],
    position: str,
    halo: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add columns that look back at most ``halo`` rows, given as functions of the window to run over.

    ``position`` counts the rows of a group without gaps.
    The last ``halo`` rows before a slice are copied into it: (slice_rows + halo) rows meet at most.
    """
    own, last = F.floor(F.col(position) / slice_rows), F.floor((F.col(position) + halo) / slice_rows)
    copies = df.withColumn("_own", own).withColumn("_slice", F.explode(F.sequence(own, last)))
    window = Window.partitionBy(*keys, "_slice").orderBy(position)
    made = copies.withColumns({name: build(window) for name, build in columns.items()})
    return made.where(F.col("_slice") == F.col("_own")).drop("_own", "_slice")
