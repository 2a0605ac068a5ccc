"""Mixing sources to target weights by subset sums.

Every source gets a budget of words. A source takes all its documents as often as they fit whole, and a subset for the rest, found
on counts of documents by exact length: a proportional share of each length first, longest lengths next, and for what then
remains, at most DP_WORDS, bounded-knapsack dynamic programming over lengths and their numbers. Which documents of a
length are taken is decided by a seeded hash: whole buckets of it first, then by rank in one bucket, so no task ranks a
whole length.

Budgets: sources in code-point order, NULL last, weigh 1, 2, 3, 1, ...; they share all words by weight, none gets more than MOST
times its own, and what is above goes to the others by weight.

Defined results: NULL and empty texts have no words and are taken 0 times. Rows are documents, also if they repeat; repeated
rows may be taken differently often, never more than MOST times each. Same rows and seed give the same result. An empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.shared import before, documents, free_names, row_tag, under_plain_names, written

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 17
DP_WORDS = 1 << 16
HASH_BUCKETS = 256
WORD = r"[^ \t\n\x0B\f\r]+"


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to ``budget``, or nearly."""
    total = int(lengths @ counts)
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    left = budget - int(lengths @ taken)
    for i in np.argsort(-lengths):
        if left <= DP_WORDS:
            break
        more = min(int(counts[i] - taken[i]), (left - DP_WORDS // 2) // int(lengths[i]))
        taken[i] += more
        left -= more * int(lengths[i])
    taken += _knapsack(lengths, counts - taken, left)
    left = budget - int(lengths @ taken)
    over = [i for i in np.flatnonzero(counts > taken) if lengths[i] < 2 * left]
    if over:  # one more comes nearer than none
        taken[min(over, key=lambda i: abs(int(lengths[i]) - left))] += 1
    longer = np.flatnonzero(lengths > budget)
    if len(longer) and lengths[longer].min() - budget < abs(budget - int(lengths @ taken)):  # one long document alone
        taken[:] = 0
        taken[longer[lengths[longer].argmin()]] = 1
    return taken


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack up to ``budget``, or up to DP_WORDS if that is less: numbers split into powers of two, and for each sum the item that first reached it."""
    most = min(budget, DP_WORDS)
    reached, via = np.zeros(most + 1, bool), np.full(most + 1, -1)
    reached[0] = True
    items = []
    for i in np.flatnonzero((counts > 0) & (lengths <= most)):
        rest, power = min(int(counts[i]), most // int(lengths[i])), 1
        while rest > 0:
            number = min(power, rest)
            size = number * int(lengths[i])
            new = reached[: most + 1 - size] & ~reached[size:]
            places = np.flatnonzero(new) + size
            reached[places], via[places] = True, len(items)
            items.append((i, number, size))
            rest, power = rest - number, power * 2
        if reached[most]:
            break
    taken = np.zeros(len(lengths), np.int64)
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, number, size = items[via[at]]
        taken[i] += number
        at -= size
    return taken


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size, target. The driver sees sums over the sources, never the sources."""
    ranked = before(sources, [F.col("source").asc_nulls_last()], F.lit(1).cast("long"), "rank")
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    weighed = written(ranked.withColumn("weight", weight))
    most = F.lit(MOST) * F.col("source_size")
    total, level, seen = None, 0.0, None
    while level != seen:
        seen = level
        capped = F.col("weight") * F.lit(level) > most
        row = weighed.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(capped, most)).alias("capped"), F.sum(F.when(~capped, F.col("weight"))).alias("weights")
        ).first()
        total = row["words"] or 0
        level = (total - (row["capped"] or 0)) / row["weights"] if row["weights"] else level
    return weighed.select("source", "source_size", F.least(F.col("weight") * F.lit(level), most.cast("double")).alias("target"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, tag, size, source_size, target, copies (how often the mix takes the document)."""
    sizes = docs.select("doc_id", row_tag().alias("tag"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tag"))
    base = written(sizes.withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(HASH_BUCKETS)).cast("int")))
    buckets = written(base.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")))
    lengths = buckets.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goals = written(targets(written(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))))
    goal = goals.select(F.col("source").alias("s"), "source_size", "target")
    wanted = lengths.where("size > 0").join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        words, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        whole = min(int(target // words), MOST)
        rest = round(target - whole * words)
        taken = fit_budget(group["size"].to_numpy(), group["n"].to_numpy(), rest) if whole < MOST else 0
        return pd.DataFrame({"source": group["source"], "size": group["size"], "whole": whole, "extra": taken})

    # A group is the distinct lengths of one source, not its documents.
    taken = written(wanted.groupBy("source").applyInPandas(fit, "source string, size bigint, whole int, extra bigint"))
    taken = taken.select(F.col("source").alias("s"), F.col("size").alias("z"), "whole", "extra")
    earlier = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("n")
    cut = buckets.withColumn("earlier", earlier).join(taken, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    cut = written(cut.select("s", "z", F.col("bucket").alias("b"), "whole", F.greatest(F.least(F.col("extra") - F.col("earlier"), F.col("n")), F.lit(0)).alias("some"), "n"))
    met = base.join(cut, base.source.eqNullSafe(cut.s) & (base["size"] == cut.z) & (base.bucket == cut.b), "left")
    split = (F.col("some") > 0) & (F.col("some") < F.col("n"))
    clear = met.where(F.coalesce(~split, F.lit(True))).withColumn("more", F.coalesce(F.col("some") > 0, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id", "tag"))
    edge = met.where(split).withColumn("more", rank <= F.col("some"))
    judged = clear.unionByName(edge).withColumn("copies", F.coalesce(F.col("whole"), F.lit(0)) + F.col("more").cast("int"))
    return judged.drop("s").join(goal, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "tag", "size", "source_size", "target", "copies")


@under_plain_names
def take_mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    own_id, own_tag, times, row, copy = free_names(docs, "own_id", "own_tag", "times", "row", "copy")
    copies = mix(docs, seed).where("copies > 0").groupBy("doc_id", "tag").agg(F.sum("copies").cast("int").alias(times))
    copies = copies.withColumnsRenamed({"doc_id": own_id, "tag": own_tag})
    met = docs.join(copies, docs["doc_id"].eqNullSafe(copies[own_id]) & (row_tag() == copies[own_tag]))
    # Rows equal in doc_id and text count together; the first stands for them.
    met = met.withColumn(row, F.row_number().over(Window.partitionBy(own_id, own_tag).orderBy(times))).where(F.col(row) == 1)
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*(docs[c] for c in docs.columns))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(documents(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
