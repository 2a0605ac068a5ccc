"""Hard-negative mining with Fagin's threshold algorithm.

Rows are dealt into blocks of some thousand rows, anchors into blocks likewise, and each block of rows meets each block of anchors
once: a stated set of queries against all rows. Within such a cell every dimension has a list of the rows sorted by that component.
An anchor reads the lists from the top where its own component is positive and from the bottom where it is negative (sorted
access), and scores each row it meets for the first time by the whole integer inner product (random access). The threshold, the
score of a row made of the values last read, bounds all rows not met yet. Reading stops once it lies strictly below the kth
best score, so rows that tie are always met.

Positives come first, from lists of the rows of one label: the best few of a cell are merged by anchor. Each positive then opens a
window of scores; negatives are read from the lists of the other rows, all windows of an anchor at once, until the threshold lies strictly
below each window's kth score, or below its lower end where it holds fewer. What cells report is at most k rows a window, ranked again over
all cells. No candidate is dropped by a cap: a cell whose rows all tie is read to the end.

Scores are exact: products of a cell that could leave the 53 bits of a double are taken in 64-bit integers.

Defined results: rows with a NULL vec_id, label or vector, or a component that is NULL or not finite, take no part, nor do vectors so
large that an inner product could leave 2^55 (components of about 80,000 in 64 dimensions). Missing components of a shorter vector count as
zero; an empty vector scores zero. Repeated rows are rows of their own: each is an anchor, and a positive or negative beside the
others; ties go to the smaller vec_id. An anchor without positives, or a positive without negatives, gives no row; an empty table
an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.shared import written

POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these shares of its positive's score, in percent.
LOWEST, HIGHEST = 50, 95
SCALE = 256
#: Rows and anchors of one cell.
ROWS, ANCHORS = 2048, 2048
#: Entries of each list that are read before the first check; then twice as many each time.
FIRST_READ = 32
_EXACT_IN_DOUBLE = 2**53
_LARGEST = 2.0**55


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and v, the scaled components, of all rows that take part."""
    number = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    # NaN is larger than infinity in Spark's order, so the comparison leaves it out too.
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    largest = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & number)
        .select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), v.alias("v"))
        .where(F.size("v") * largest * largest <= _LARGEST)
        .withColumn("v", F.col("v").cast("array<int>"))
    )


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _dealt(df: DataFrame, blocks: int, name: str) -> DataFrame:
    """Rows of a written table in turn into blocks, whatever they hold."""
    return df.withColumn(name, F.expr(f"cast(pmod(monotonically_increasing_id(), {blocks}) as int)"))


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    lists = table.column("v").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    found = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    found[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def _width(*tables: pa.Table) -> int:
    return max(pc.max(pc.list_value_length(t.column("v"))).as_py() or 0 for t in tables)


def _arithmetic(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    largest = [int(np.abs(x).max(initial=0)) for x in (rows, anchors)]
    if rows.shape[1] * largest[0] * largest[1] < _EXACT_IN_DOUBLE:
        return rows.astype(np.float64), anchors.astype(np.float64)
    return rows, anchors


class Lists:
    """The rows of a block, sorted by each component."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)

    def search(self, anchor: np.ndarray, bound: Callable[[np.ndarray, np.ndarray], float]) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the rows met until the threshold is below ``bound(met, scores)``, the least score still of use.

        ``scores`` has a place for each row, and holds what is under ``met``. A row not met scores the threshold at most.
        """
        n = len(self.rows)
        met, scores = np.zeros(n, bool), np.zeros(n, self.rows.dtype)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            return np.ones(n, bool), scores
        read, depth = 0, 0
        while read < n:
            # Before the first read, the heads of the lists bound all rows.
            edge = max(read - 1, 0)
            threshold = self.sorted[n - 1 - edge, up] @ anchor[up] + self.sorted[edge, down] @ anchor[down]
            if threshold < bound(met, scores):
                return met, scores
            depth = min(n, max(FIRST_READ, 2 * read))
            new = np.zeros(n, bool)
            new[self.order[n - depth : n - read][:, up]] = True
            new[self.order[read:depth][:, down]] = True
            new &= ~met
            scores[new] = self.rows[new] @ anchor
            met |= new
            read = depth
        return met, scores


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def _best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of a cell: the first rows of each anchor's label."""
    width = _width(left, right)
    rows, anchors = _arithmetic(_matrix(left, width), _matrix(right, width))
    label, ids, row = (left.column(c).to_numpy() for c in ("label", "vec_id", "row"))
    of_label = {x: np.flatnonzero(label == x) for x in np.unique(label)}
    lists = {x: Lists(rows[at]) for x, at in of_label.items()}
    found: list[tuple] = []
    for anchor, own, own_label in zip(anchors, right.column("row").to_pylist(), right.column("label").to_pylist(), strict=True):
        if own_label not in lists:
            continue
        at = of_label[own_label]
        other = row[at] != own
        met, scores = lists[own_label].search(anchor, lambda met, scores, other=other: _kth(scores[met & other], POSITIVES))
        place = np.flatnonzero(met & other)
        best = place[np.lexsort((ids[at[place]], -scores[place]))[:POSITIVES]]
        found += [(own, int(row[at[p]]), int(ids[at[p]]), int(scores[p])) for p in best]
    return pa.table([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 4, names=_POSITIVE)


_POSITIVE = ["anchor_row", "positive_row", "positive_id", "positive_score"]
_FOUND = ["anchor_row", "positive_row", "negative_id", "negative_score"]


def _best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of a cell: the first rows of other labels within each window of each anchor."""
    width = _width(left, right)
    rows, anchors = _arithmetic(_matrix(left, width), _matrix(right, width))
    label, ids = (left.column(c).to_numpy() for c in ("label", "vec_id"))
    lists = Lists(rows)
    windows = right.column("windows").to_pylist()
    found: list[tuple] = []
    for anchor, own, own_label, mine in zip(anchors, right.column("row").to_pylist(), right.column("label").to_pylist(), windows, strict=True):
        lows, highs = np.array([w["low"] for w in mine]), np.array([w["high"] for w in mine])
        other = label != own_label

        def bound(met, scores, lows=lows, highs=highs, other=other):
            """The least of all windows: the kth score in it, or its lower end."""
            some = np.sort(scores[met & other])
            kth = np.searchsorted(some, highs, side="right") - NEGATIVES
            return np.maximum(lows, np.where(kth >= 0, some[np.maximum(kth, 0)], lows)).min() if len(some) else lows.min()

        met, scores = lists.search(anchor, bound)
        place = np.flatnonzero(met & other & (scores >= lows.min()) & (scores <= highs.max()))
        place = place[np.lexsort((ids[place], -scores[place]))]
        falling = -scores[place]
        for w in mine:
            begin = np.searchsorted(falling, -w["high"])
            best = place[begin : begin + NEGATIVES]
            found += [(own, w["positive_row"], int(ids[p]), int(scores[p])) for p in best[scores[best] >= w["low"]]]
    return pa.table([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 4, names=_FOUND)


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, step: Callable, names: list[str]) -> DataFrame:
    """Every block of rows with every block of anchors."""
    row_blocks, anchor_blocks = _blocks(n_rows, ROWS), _blocks(n_anchors, ANCHORS)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = _dealt(rows, row_blocks, "row_block").select("*", every(anchor_blocks, "anchor_block"))
    right = _dealt(anchors, anchor_blocks, "anchor_block").select("*", every(row_blocks, "row_block"))
    keys = ("row_block", "anchor_block")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return step(a, b) if a.num_rows and b.num_rows else step(a.slice(0, 0), b.slice(0, 0))

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _first(df: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """For rows vec_id, label, v (see ``usable``): anchor_id, positive_id, rank, negative_id and both scores."""
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    anchors = written(rows.where(is_anchor))
    n_rows, n_anchors = rows.count(), anchors.count()
    near = _cells(rows, anchors, n_rows, n_anchors, _best_positives, _POSITIVE)
    positives = written(_first(near, ["anchor_row"], "positive_score", "positive_id", POSITIVES).drop("rank"))
    low, high = F.expr(f"({LOWEST} * positive_score + 99) div 100"), F.expr(f"({HIGHEST} * positive_score) div 100")
    window = F.struct("positive_row", low.alias("low"), high.alias("high"))
    # Below zero the larger share is the smaller number: such a window is empty.
    windows = positives.where(F.col("positive_score") >= 0).groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(window).alias("windows"))
    asking = written(anchors.join(windows, "row"))
    far = _cells(rows, asking, n_rows, n_anchors, _best_negatives, _FOUND)
    best = _first(far, ["anchor_row", "positive_row"], "negative_score", "negative_id", NEGATIVES)
    named = positives.join(anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return best.join(named, ["anchor_row", "positive_row"]).select(*columns)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL = """
WITH numbered AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT r, vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM numbered),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(SUM(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.d = b.d AND a.r <> b.r
  WHERE a.vec_id % 50 = 0
  GROUP BY ALL
),
positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
