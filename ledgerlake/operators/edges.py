"""Exact quantile edges of whole tables, found digit by digit.

Each round counts the rows by the next digit of their value, for those that share the leading digits of an edge found so far. What
is shuffled is one count per digit and task, and what reaches the driver is one row per edge; no value is ever sorted, and no
task sees more than its own part of the table, however the values are spread and however often one repeats.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 12


def exact_edges(df: DataFrame, columns: dict[str, Column], parts: int) -> dict[str, list[int]]:
    """For each column the values at ranks ceil(k * n / parts), k = 1 .. parts - 1, in ascending order.

    Columns are whole numbers (cents, days), which lie less than 2^62 apart; NULLs are left out. A column without values has no
    edges. With fewer values than parts, edges repeat.
    """
    wide = df.select(*[c.cast("bigint").alias(name) for name, c in columns.items()])
    bounds = wide.agg(
        *[f(name).alias(f"{name}_{what}") for name in columns for what, f in (("low", F.min), ("high", F.max), ("n", F.count))]
    ).first()
    low = {name: bounds[f"{name}_low"] for name in columns if bounds[f"{name}_n"]}
    if not low:
        return {name: [] for name in columns}
    longest = max(bounds[f"{name}_high"] - low[name] for name in low).bit_length()
    shift = -(-longest // DIGIT_BITS) * DIGIT_BITS
    values = wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), (F.col(n) - low[n]).alias("v")) for n in low])).alias("x"))
    values = values.select("x.*").where(F.col("v").isNotNull())
    # Of each edge: its column, its leading digits so far, and its rank among the rows that share them.
    edges = [(name, 0, -(-k * bounds[f"{name}_n"] // parts)) for name in low for k in range(1, parts)]
    while shift:
        shift -= DIGIT_BITS
        edges = _next_digit(values, edges, shift)
    return {name: [prefix + low[name] for n, prefix, _ in edges if n == name] for name in columns}


def _next_digit(values: DataFrame, edges: Sequence[tuple[str, int, int]], shift: int) -> list[tuple[str, int, int]]:
    prefix, digits = F.shiftright("v", shift + DIGIT_BITS), F.shiftright("v", shift)
    open_at = {(name, before) for name, before, _ in edges}
    shares = reduce(Column.__or__, [(F.col("name") == name) & (prefix == before) for name, before in sorted(open_at)])
    counts = values.where(shares).groupBy("name", prefix.alias("prefix"), digits.alias("digits")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("name", "prefix").orderBy("digits"))
    running = counts.withColumn("upto", upto)
    tests = [(F.col("name") == n) & (F.col("prefix") == b) & (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank) for n, b, rank in edges]
    found = running.where(reduce(Column.__or__, tests)).collect()  # at most one row per edge
    result = []
    for name, before, rank in edges:
        row = next(r for r in found if (r.name, r.prefix) == (name, before) and r.upto - r.n < rank <= r.upto)
        result.append((name, row.digits, rank - (row.upto - row.n)))
    return result


def part_of(value: Column, edges: Sequence[int]) -> Column:
    """1 for values up to the first edge, and one more for each edge below the value; equal values are never parted."""
    return reduce(Column.__add__, [(value > F.lit(e)).cast("int") for e in edges], F.lit(1))
