"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed is a fixed mask over a few consecutive tokens that looks at some of them and ignores the others, so that a substituted token
at an ignored place leaves the hash unchanged. The masks are complete: whatever tokens of a frame are substituted, as long as the rule
below accepts it, one mask fits between them somewhere (a test goes through all such patterns). The hashes of all places of all texts are joined with those of the benchmark. A hit
fixes how text and item lie on each other; the tokens of the item's whole length are then compared place by place. The
overlap is confirmed if some FRAME aligned tokens agree in at least LEAST of their places, and it is reported with the number
of agreeing tokens and the span of the agreeing frames.

Tokens are maximal runs of letters and digits, lower-cased, so punctuation and case do not hide a passage.

Defined results: NULL and empty texts and items have no tokens. For items shorter than FRAME the frame is the item. Items of
fewer than SPAN tokens are found where all their tokens agree, by one seed over the whole item; those of fewer than SHORTEST tokens are
too short to prove anything and match nothing. Texts may be shorter than items. Repeated documents or items are found once per distinct row.
Of alignments with equally many agreeing tokens the earliest in the text is reported. Texts of any length are compared whole.
A NULL doc_id or item_id is reported as NULL. Empty tables give an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents, row_tag, written

#: Places that count. They begin and end with one, so places outside the text are borne like substitutions.
MASKS = ("111011", "110100011", "1001111", "111000101")
SPAN = 9
SHORTEST = 3
FRAME = 13
LEAST = 10
#: Benchmark seeds are broadcast up to this number (16 bytes each and as much again for the table); more are joined by shuffle.
BROADCAST_SEEDS = 1_000_000


def _tokens(text: str) -> Column:
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, keep: list[str], masks: dict[int, str]) -> DataFrame:
    """A row per place and mask: the seed's hash and ``at``, its first token (from 0)."""
    placed = rows.select(*keep, "tokens", F.posexplode("tokens").alias("at", "_")).where(F.col("at") <= F.size("tokens") - min(map(len, masks.values())))
    hashes = []
    for i, mask in masks.items():
        seed = F.xxhash64(F.lit(i), *(F.get("tokens", F.col("at") + k) for k in range(len(mask)) if mask[k] == "1"))
        hashes.append(F.when(F.col("at") <= F.size("tokens") - len(mask), seed))
    return placed.select(*keep, "tokens", "at", F.explode(F.array(*hashes)).alias("seed")).where("seed IS NOT NULL")


def _whole_masks(items: DataFrame) -> dict[int, str]:
    """One mask for each length of short items that occurs, at most SPAN - SHORTEST in all."""
    short = items.select(F.size("tokens").alias("n")).where(F.col("n").between(SHORTEST, SPAN - 1)).distinct()
    return {-r["n"]: "1" * r["n"] for r in short.collect()}


def _index(items: DataFrame, whole: dict[int, str]) -> DataFrame:
    """seed, item_id, item_tag, item_at, n (tokens of the item)."""
    keep = ["item_id", "item_tag"]
    seeds = _seeds(items.where(F.size("tokens") >= SPAN), keep, dict(enumerate(MASKS)))
    for i, mask in whole.items():
        seeds = seeds.unionByName(_seeds(items.where(F.size("tokens") == len(mask)), keep, {i: mask}))
    return seeds.select("seed", *keep, F.col("at").alias("item_at"), F.size("tokens").alias("n"))


def _laid(tokens: DataFrame, index: DataFrame, masks: dict[int, str]) -> DataFrame:
    """doc_id, tag, item_id, item_tag, start, part: each alignment with a hit, and the tokens of the text on which the item would lie.

    ``start`` is negative where the item begins before the text. An index too large to broadcast is met by seeds without texts;
    the tokens come back by one join, once for each alignment.
    """
    keys = ["doc_id", "tag", "item_id", "item_tag", "start"]
    start = (F.col("at") - F.col("item_at")).alias("start")
    cut = F.slice("tokens", F.greatest("start", F.lit(0)) + 1, F.col("n") + F.least("start", F.lit(0))).alias("part")
    if index.count() <= BROADCAST_SEEDS:
        hits = _seeds(tokens, ["doc_id", "tag"], masks).join(F.broadcast(index), "seed").select(*keys[:-1], start, "tokens", "n")
    else:
        hits = _seeds(tokens, ["doc_id", "tag"], masks).drop("tokens").join(index, "seed").select(*keys[:-1], start, "n").distinct()
        texts = tokens.toDF("d", "t", "tokens")
        hits = hits.join(texts, hits.doc_id.eqNullSafe(texts.d) & (hits.tag == texts.t))
    return hits.select(*keys, cut).groupBy(*keys).agg(F.first("part").alias("part"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tag, item_id, n_item_tokens, n_agreeing, first and last agreeing item token: the best alignment of each pair."""
    items = written(benchmark.select(F.col("item_id"), row_tag().alias("item_tag"), _tokens("text").alias("tokens")).distinct())
    whole = _whole_masks(items)
    tokens = docs.select("doc_id", row_tag().alias("tag"), _tokens("text").alias("tokens"))
    laid = _laid(tokens, written(_index(items, whole)), dict(enumerate(MASKS)) | whole)
    item = items.select(F.col("item_id").alias("i"), F.col("item_tag").alias("t"), F.col("tokens").alias("item"))
    met = laid.join(item, laid.item_id.eqNullSafe(item.i) & (laid.item_tag == item.t))
    before = F.greatest(-F.col("start"), F.lit(0))
    agrees = F.transform("item", lambda token, i: (F.coalesce(F.get("part", i - before) == token, F.lit(False)) & (i >= before)).cast("int"))
    met = met.select("doc_id", "tag", "item_id", "item_tag", "start", agrees.alias("agrees"), F.size("item").alias("n"))
    frame = F.least(F.col("n"), F.lit(FRAME))
    total = F.aggregate("agrees", F.lit(0), lambda acc, a: acc + a)
    inside = F.sequence(F.lit(0), F.col("n") - frame)
    enough = F.filter(inside, lambda i: F.aggregate(F.slice("agrees", i + 1, frame), F.lit(0), lambda acc, a: acc + a) * FRAME >= LEAST * frame)
    met = met.withColumn("total", total).where((F.col("n") >= SPAN) | (F.col("total") == F.col("n")))
    met = met.withColumn("frames", enough).where(F.size("frames") > 0)
    rated = met.select(
        "doc_id", "tag", "item_id", "item_tag",
        F.struct(
            F.col("total").alias("n_agreeing"), (-F.col("start")).alias("early"), F.col("n").alias("n_item_tokens"),
            F.array_min("frames").alias("first_token"), (F.array_max("frames") + frame - 1).alias("last_token"),
        ).alias("found"),
    )
    best = rated.groupBy("doc_id", "tag", "item_id", "item_tag").agg(F.max("found").alias("found"))
    return best.select(
        "doc_id", "tag", "item_id", "found.n_item_tokens", "found.n_agreeing", (-F.col("found.early")).alias("doc_token"),
        "found.first_token", "found.last_token",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a confirmed overlap, with all their columns."""
    bad = written(contaminated(docs, benchmark).select(F.col("doc_id").alias("_d"), F.col("tag").alias("_t")).distinct())
    side = F.broadcast(bad) if bad.count() <= BROADCAST_SEEDS else bad
    return docs.join(side, docs["doc_id"].eqNullSafe(side["_d"]) & (row_tag() == side["_t"]), "left_anti")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("tag")


#: By the rule alone. Where 10 of 13 tokens agree (or as large a share of a shorter item), three agree in a row, since those that differ
#: cut them into too few runs; an item of fewer than 9 tokens agrees as a whole. So alignments are found by any three tokens in a row.
SQL = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS d, doc_id, w FROM (
        SELECT DISTINCT doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
    )
), items AS MATERIALIZED (
    SELECT row_number() OVER () AS e, item_id, v, len(v) AS n, least(len(v), 13) AS frame FROM (
        SELECT DISTINCT item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS v FROM benchmark
    )
), doc_grams AS (
    SELECT d, p, concat_ws(' ', w[p], w[p + 1], w[p + 2]) AS s FROM (SELECT d, w, unnest(range(1, len(w) - 1)) AS p FROM docs)
), item_grams AS (
    SELECT e, q, concat_ws(' ', v[q], v[q + 1], v[q + 2]) AS s FROM (SELECT e, v, unnest(range(1, len(v) - 1)) AS q FROM items)
), laid AS (
    SELECT DISTINCT d, e, p - q AS start FROM doc_grams JOIN item_grams USING (s)
), agreeing AS (
    SELECT d, e, start, i, n, frame, (start + i >= 0 AND coalesce(w[start + i + 1] = v[i + 1], false))::INT AS a
    FROM (SELECT d, e, start, v, w, n, frame, unnest(range(n)) AS i FROM laid JOIN docs USING (d) JOIN items USING (e))
), summed AS (
    SELECT *, sum(a) OVER (PARTITION BY d, e, start ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS f,
        sum(a) OVER (PARTITION BY d, e, start) AS total
    FROM agreeing
), rated AS (
    SELECT d, e, start, any_value(n) AS n, any_value(total) AS total, min(i - frame + 1) AS first_token, max(i) AS last_token
    FROM summed WHERE i >= frame - 1 AND f * 13 >= 10 * frame AND (n >= 9 OR total = n) GROUP BY d, e, start
)
SELECT doc_id, item_id, n::INT AS n_item_tokens, total::INT AS n_agreeing, start::INT AS doc_token, first_token::INT AS first_token,
    last_token::INT AS last_token
FROM (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY d, e ORDER BY total DESC, start) = 1)
JOIN docs USING (d) JOIN (SELECT e, item_id FROM items) USING (e)
"""
