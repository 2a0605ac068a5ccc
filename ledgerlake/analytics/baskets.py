"""Products that are bought together: frequent pairs, counted without a row for each pair of a basket.

Two passes over the baskets, cut down to their frequent products. The first hashes every pair into a fixed array of counters, one
array a task, and adds the arrays up by slices; a counter is the number of baskets that hit it, so no pair occurs more often than its
counter says. The second counts only pairs whose counter reaches the minimum, in the task, and sends out one row per pair and task.
A basket with many frequent products is cut into chunks, and each two chunks are a unit of work of their own. Every product has
one of 32 classes, the classes of a pair choose the region of its counter, and chunks follow classes, so the units of one basket hit
different counters and the basket still counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import ratio
from ledgerlake.operators.groups import attach_group_value
from ledgerlake.session import stored

#: Share of all baskets, and number of baskets, that a product and a pair must occur in.
MINIMUM_SUPPORT, LEAST_BASKETS = 0.00001, 2
CLASSES, IN_REGION = 32, 1024
COUNTERS = CLASSES * CLASSES * IN_REGION
SLICES = 64
#: Products of a chunk of a large basket, on average.
CHUNK = 256
#: Pairs that a task counts before it sends them out.
HELD_PAIRS = 1 << 20


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of products of units of work, the smaller number first, in bounded portions; True where all are of one basket."""
    left, right = batch.column("left"), batch.column("right")
    whole = np.array(right.is_null())
    ends = left.offsets.to_numpy()
    for i in np.flatnonzero(~whole):
        a, b = np.array(left.values[ends[i] : ends[i + 1]]), np.array(right[int(i)].values)
        a, b = np.repeat(a, len(b)), np.tile(b, len(a))
        yield np.minimum(a, b), np.maximum(a, b), True
    sizes = np.diff(ends)
    large = whole & (sizes > 32)
    for i in np.flatnonzero(large):
        x = np.sort(np.array(left.values[ends[i] : ends[i + 1]]))
        a, b = np.triu_indices(len(x), 1)
        yield x[a], x[b], True
    small = np.flatnonzero(whole & ~large)
    at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in small]) if len(small) else np.zeros(0, np.int64)
    items, row = np.array(left.values)[at], np.repeat(small, sizes[small])
    for d in range(1, int(sizes[small].max(initial=0))):
        same = row[d:] == row[:-d]
        a, b = items[:-d][same], items[d:][same]
        yield np.minimum(a, b), np.maximum(a, b), False


def _counter(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    region = (a % CLASSES) * CLASSES + b % CLASSES
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return region * IN_REGION + ((x >> np.uint64(32)) % np.uint64(IN_REGION)).astype(np.int64)


def _count_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for a, b, one_basket in _pairs(batch):
            hits = _counter(a, b)
            if one_basket:
                counters[np.unique(hits)] += 1
            else:
                np.add.at(counters, hits, 1)
    for i, part in enumerate(np.split(counters, SLICES)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counters"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the slices of a task, bounded by the array as a whole."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, counters in zip(batch.column("slice").to_pylist(), batch.column("counters").to_pylist(), strict=True):
            part = np.frombuffer(counters, np.int64)
            sums[i] = sums[i] + part if i in sums else part
    for i, part in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counters"])


def _added(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.add.reduceat(n, first) if len(a) else n


def count_pairs(units: DataFrame, least: int) -> DataFrame:
    """a, b and n for pairs of products in units of work; partial counts, of pairs whose counter reaches ``least``."""
    spark = units.sparkSession
    slice_schema = "slice int, counters binary"
    hits = units.mapInArrow(_count_hits, slice_schema).repartition(SLICES, "slice").mapInArrow(_add_up, slice_schema)
    open_counters = np.zeros(COUNTERS, bool)
    size = COUNTERS // SLICES
    for row in hits.toLocalIterator():  # the fixed array, one slice at a time
        open_counters[row.slice * size : (row.slice + 1) * size] = np.frombuffer(row.counters, np.int64) >= least
    shared = spark.sparkContext.broadcast(np.packbits(open_counters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.unpackbits(shared.value).astype(bool)
        held, size, distinct = [(np.zeros(0, np.int64),) * 3], 0, 0

        def sent():
            a, b, n = _added(*(np.concatenate(c) for c in zip(*held, strict=True)))
            return [(a, b, n)], len(a)

        def rows():
            for begin in range(0, len(held[0][0]), 1 << 16):
                columns = [pa.array(c[begin : begin + (1 << 16)], pa.int64()) for c in held[0]]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

        for batch in batches:
            for a, b, _ in _pairs(batch):
                kept = may[_counter(a, b)]
                if kept.any():
                    held.append((a[kept], b[kept], np.ones(int(kept.sum()), np.int64)))
                    size += int(kept.sum())
                if size >= distinct + HELD_PAIRS:
                    held, size = sent()
                    distinct = size
                    if distinct >= HELD_PAIRS:
                        yield from rows()
                        held, size, distinct = [(np.zeros(0, np.int64),) * 3], 0, 0
        held, _ = sent()
        yield from rows()

    return units.mapInArrow(run, "a bigint, b bigint, n bigint")


def _units(frequent: DataFrame) -> DataFrame:
    """left and right: the products of a basket and NULL, or those of two chunks of a large basket."""
    sizes = frequent.groupBy("_basket").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    needed = F.ceil(F.col("_n") / CHUNK)
    # Up to 32 chunks take whole classes, so their number is a power of two; beyond, each class is cut further.
    power = F.pow(F.lit(2), F.ceil(F.log2(needed))).cast("bigint")
    chunks = F.when(needed <= CLASSES, power).otherwise(CLASSES * F.ceil(needed / CLASSES))
    dealt = attach_group_value(frequent, "_basket", sizes.withColumn("_chunks", chunks), "_chunks", "_n", spread="_item")
    own = F.expr(
        f"if(_chunks <= {CLASSES}, (_item % {CLASSES}) div ({CLASSES} div _chunks), "
        f"(_item % {CLASSES}) * (_chunks div {CLASSES}) + pmod(xxhash64(_item, 7), _chunks div {CLASSES}))"
    )
    cut = dealt.where(F.col("_chunks").isNotNull()).withColumn("_chunk", own)
    lists = cut.groupBy("_basket", "_chunks", "_chunk").agg(F.collect_list("_item").alias("_items"))
    whole = lists.where(F.col("_chunks") == 1).select(F.col("_items").alias("left"), F.lit(None).cast("array<bigint>").alias("right"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_chunks") - 1))
    copies = lists.where(F.col("_chunks") > 1).withColumn("_other", other)
    both = copies.groupBy("_basket", F.least("_chunk", "_other").alias("_one"), F.greatest("_chunk", "_other").alias("_two")).agg(
        F.collect_list("_items").alias("_lists")
    )
    # A chunk with itself is one list; where the other chunk is empty there is no pair between the two.
    itself = F.col("_one") == F.col("_two")
    parts = both.where(itself | (F.size("_lists") == 2))
    return whole.unionByName(parts.select(F.get("_lists", F.lit(0)).alias("left"), F.get("_lists", F.lit(1)).alias("right")))


def basket_pairs(
    baskets: DataFrame,
    minimum_support: float = MINIMUM_SUPPORT,
    least_baskets: int = LEAST_BASKETS,
    basket: str = "order_id",
    item: str = "product_id",
) -> DataFrame:
    """Rules between two products that meet in at least max(least_baskets, minimum_support * baskets) baskets, one row each way.

    ``support`` is the share of all baskets with both, ``confidence`` that of the antecedent's baskets that hold the consequent too,
    ``lift`` the confidence over the consequent's own share. A product counts once in a basket, however often it has a row; rows without
    basket or product are no part of any.
    """
    held = stored(baskets.select(F.col(basket).alias("_basket"), F.col(item).alias("_name")).where(f"`{basket}` IS NOT NULL AND `{item}` IS NOT NULL").distinct())
    n_baskets = held.agg(F.countDistinct("_basket")).first()[0]
    least = max(least_baskets, 1, -(-int(minimum_support * 10**12) * n_baskets // 10**12))
    counts = held.groupBy("_name").agg(F.count("*").alias("_count")).where(F.col("_count") >= least)
    number = F.monotonically_increasing_id() * CLASSES + F.pmod(F.xxhash64("_name"), F.lit(CLASSES))
    items = stored(counts.withColumn("_item", number))
    frequent = stored(held.join(items.select("_name", "_item"), "_name").select("_basket", "_item"))
    pairs = count_pairs(stored(_units(frequent)), least).groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    directions = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("d")
    named = lambda prefix, key: items.select(F.col("_item").alias(key), F.col("_name").alias(f"{prefix}_id"), F.col("_count").alias(f"{prefix}_count"))
    rules = pairs.select("n", directions).select("n", "d.x", "d.y").join(named("antecedent", "x"), "x").join(named("consequent", "y"), "y")
    n, total = F.col("n"), F.lit(n_baskets)
    return rules.select(
        "antecedent_id",
        "consequent_id",
        "antecedent_count",
        "consequent_count",
        n.alias("basket_count"),
        ratio(n, total).alias("support"),
        ratio(n, F.col("antecedent_count")).alias("confidence"),
        (n.cast("double") * total.cast("double") / (F.col("antecedent_count").cast("double") * F.col("consequent_count").cast("double"))).alias("lift"),
    )
