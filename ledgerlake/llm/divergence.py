"""Source divergence audit: how far the words of a language's sources lie apart, from in-mapper stripes.

Partitions fold whole documents into stripes, one for each term of a language: the documents that hold it, and how often each
source says it. A task that holds SPILL counts sends its stripes out and starts anew. Stripes of a term are merged by key: they are
shuffled once, by language and term, and what they hold is added up where it arrives; a term comes at most once from each spill of a task, so
frequent terms are no heavier than others. A merged stripe is all that the divergences of its term need, beside one row for each source of
its language. Stripes are dealt in blocks of some thousand terms; a block gives its share of each pair of sources, and
the first few terms of each source, and these are added and ranked over the blocks.

All numbers are exact: 64-bit integers with no product above 10^18, shares by long division.

Defined results: NULL text, lang and source count as ''. A language without kept terms has pairs of value 0 and no term rows; one
with a single source has no pairs. Ties of value go to the item that comes first in UTF-8. Repeated rows are documents of their own. Texts are
read whole, however long. An empty table gives an empty result; other columns play no part. Counts must stay below 9 * 10^15. The pairs
asked for grow with the square of a language's sources, and so does the work on a block.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents, pieces, small_batches, written

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCUMENTS = 10
SHARES = 1_000_000_000
TOP = 10
#: Counts that a task holds before it sends its stripes out.
SPILL = 500_000
#: Terms of a block, numbers of the table of shares that a block handles at a time.
BLOCK_TERMS, AT_A_TIME = 8192, 1 << 20
#: Bytes of text whose terms are listed at once.
LISTED = 4 << 20
STRIPE = "lang string, term string, documents bigint, sources array<string>, counts array<bigint>"


class Stripes:
    """Counts by (lang, source) and term, and documents by lang and term; both are one stripe a term when sent out."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.documents: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, text: bytes, lang: str, source: str) -> None:
        counts, lowered = self.counts[lang, source], text.lower()  # of bytes: A-Z only
        before = len(counts)
        if len(lowered) <= LISTED:
            terms = TERM.findall(lowered)
            counts.update(terms)
            distinct = set(terms)
        else:
            distinct, found = set(), (m.group() for m in TERM.finditer(lowered))
            while some := list(islice(found, 1 << 16)):
                counts.update(some)
                distinct.update(some)
        self.documents[lang].update(list(distinct))
        self.size += len(counts) - before

    def sent(self) -> Iterator[pa.RecordBatch]:
        for lang, documents_of in self.documents.items():
            terms = list(documents_of)
            place = {t: i for i, t in enumerate(terms)}
            mine = [(s, c) for (x, s), c in self.counts.items() if x == lang and c]
            if not mine:
                continue
            term = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for _, c in mine])
            source = np.repeat(np.arange(len(mine)), [len(c) for _, c in mine])
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for _, c in mine])
            order = np.argsort(term, kind="stable")
            offsets = pa.array(np.searchsorted(term[order], np.arange(len(terms) + 1)).astype(np.int32))
            names = pa.array([s for s, _ in mine], pa.string()).take(pa.array(source[order]))
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(np.fromiter(documents_of.values(), np.int64, len(terms))),
                pa.ListArray.from_arrays(offsets, names),
                pa.ListArray.from_arrays(offsets, pa.array(count[order])),
            ]
            batch = pa.RecordBatch.from_arrays(columns, names=["lang", "term", "documents", "sources", "counts"])
            yield from (batch.slice(i, 1 << 14) for i in range(0, len(terms), 1 << 14))


def stripes(docs: DataFrame) -> DataFrame:
    """Merged stripes of all terms: lang, term, documents, and by_source, an array of (source, n)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            texts = piece.column("text").cast(pa.binary()).to_pylist()
            for text, lang, source in zip(texts, piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True):
                held.add(text, lang, source)
                if held.size >= SPILL:
                    yield from held.sent()
                    held = Stripes()
        yield from held.sent()

    # Shuffled as stripes; entries are made where they are added up, so neither grouping shuffles again.
    sent = docs.mapInArrow(run, STRIPE).repartition("lang", "term")
    each = F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "e")
    entries = sent.select("lang", "term", "documents", each).select(
        "lang", "term", F.when(F.col("at") == 0, F.col("documents")).otherwise(0).alias("documents"), F.col("e.sources").alias("source"), F.col("e.counts").alias("n")
    )
    by_source = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    return by_source.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("by_source"))


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SHARES * (count + 2) / (total + 2 * terms)), by three steps of long division in base 1000."""
    rest, below = count + 2, total + 2 * terms
    found = np.zeros(np.broadcast(rest, below).shape, np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        found = found * 1000 + digit
    return found + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _block(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block of merged stripes with the sources of its language: shares of pairs, first terms."""
    sources = right.column("source").to_pylist()
    totals = right.column("n").to_numpy()
    place = {s: i for i, s in enumerate(sources)}
    kept = int(right.column("kept")[0].as_py()) if len(sources) else 0
    lang = right.column("lang")[0].as_py() if len(sources) else ""
    between = np.zeros((len(sources), len(sources)), np.int64)
    firsts: list[list[tuple[int, bytes]]] = [[] for _ in sources]
    step = max(1, AT_A_TIME // max(1, len(sources)))
    for begin in range(0, left.num_rows, step):
        part = left.slice(begin, step).combine_chunks()
        lists = part.column("by_source").combine_chunks()
        flat = lists.flatten()
        row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
        counts = np.zeros((part.num_rows, len(sources)), np.int64)
        counts[row, np.fromiter(map(place.__getitem__, flat.field("source").to_pylist()), np.int64, len(flat))] = flat.field("n").to_numpy()
        p = shares(counts, totals[None, :], kept)
        for s in range(len(sources) - 1):
            between[s, s + 1 :] += apart(p[:, s : s + 1], p[:, s + 1 :]).sum(axis=0)
        q = shares(counts.sum(axis=1), totals.sum(), kept)
        terms = [t.encode() for t in part.column("term").to_pylist()]
        for s in range(len(sources)):
            some = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > q))
            values = apart(p[some, s], q[some])
            if len(some) > TOP:  # ties of the last place stay
                least = np.partition(values, len(values) - TOP)[len(values) - TOP]
                some, values = some[values >= least], values[values >= least]
            firsts[s] = sorted([*firsts[s], *((-int(f), terms[t]) for t, f in zip(some, values, strict=True))])[:TOP]
    between += between.T
    rows = [(s, "pair", sources[t], int(between[i, t])) for i, s in enumerate(sources) for t in range(len(sources)) if t != i]
    rows += [(s, "term", t.decode(), -f) for s, mine in zip(sources, firsts, strict=True) for f, t in mine]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.table([pa.array([lang] * len(rows), pa.string()), *columns], names=["lang", "source", "part", "item", "value"])


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank, for documents with text, lang and source."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    merged = written(stripes(plain).where(F.col("documents") >= LEAST_DOCUMENTS))
    sums = merged.select("lang", F.explode("by_source").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("n"))
    kept = merged.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = written(groups.select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", "kept")]))
    blocks = max(1, -(-merged.count() // BLOCK_TERMS))
    left = merged.withColumn("block", F.expr(f"cast(pmod(xxhash64(term), {blocks}) as int)"))
    right = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "lang string, source string, part string, item string, value bigint"
    parts = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(_block, schema)
    keys = ["lang", "source", "part"]
    summed = parts.groupBy(*keys, "item").agg(F.sum("value").alias("value"))  # a term is in one block only
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("value").desc(), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP)).select(*keys, "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(documents(spark, sf_dir))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
said AS (SELECT lang, source, r, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term FROM said GROUP BY ALL HAVING count(*) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
grouped AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM grouped g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM said GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
p AS (
  SELECT lang, source, term, n,
         1 + (CAST(1000000000 AS HUGEINT) * CAST(n + 2 AS HUGEINT)) // CAST(sum(n) OVER (PARTITION BY lang, source) + 2 * v AS HUGEINT) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * CAST(sum(n) OVER (PARTITION BY lang, term) + 2 AS HUGEINT))
           // CAST(sum(n) OVER (PARTITION BY lang) + 2 * v AS HUGEINT) AS q
  FROM grid JOIN v USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
