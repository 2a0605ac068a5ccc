"""MinHash near-dedup with tensored banding.

A document's set holds its distinct shingles of five words. Two small collections of HALVES half keys are computed, each of two
minhashes; table (i, j) is keyed by half i of the one and half j of the other. So HALVES**2 tables of four minhashes each take
4 * HALVES minhashes instead of 4 * HALVES**2. Two sets of similarity 0.75 miss all tables with a chance of about
2 * (1 - 0.75**2)**HALVES, 1 in 10,000 for 12 halves.

Documents of equal sets form one node from the start. Half keys that only one node has cannot be part of a shared table key and are
dropped before pairs of halves are formed. Within a bucket not all pairs are compared: every node is compared on the full sets with
the bucket's smallest one, then with others of its buckets as long as they are in another component; pairs inside one
component cannot change the result. What is left, pairs between components that share a bucket, is compared completely: nodes
of buckets of up to FEW pair by pair, all others in blocks, out of which only links come.

Defined results: A-Z are lower-cased. NULL, empty and blank texts have an empty set and are linked with nothing; texts of one to
four words have one shingle. Repeated rows are copies of each other. A NULL doc_id is larger than every other and
reported as NULL. An empty table gives an empty result; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.shared import documents, free_names, map_arrow, pieces, row_tag, under_plain_names, written
from ledgerlake.llm.words import Text, Words, distinct_in_rows, mix

SHINGLE = 5
SIMILAR = 75
HALVES = 12
STAR_ROUNDS = 1
BLOCK = 256
#: Nodes in buckets of up to this many are paired row by row; larger buckets are compared in blocks.
FEW = 4
_PER_HALF = 2
_DRAW = np.random.default_rng(75)
_FLIP = _DRAW.integers(0, 2**63, 2 * HALVES * _PER_HALF, dtype=np.uint64)
_TIMES = _DRAW.integers(0, 2**63, 2 * HALVES * _PER_HALF, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _DRAW.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and 64-bit name of each text's distinct shingles, ordered by row and name; the number of texts."""
    words = Words.of(Text.of(texts, lower=True))
    hashes, counts = words.hashes(), words.counts
    at = words.windows(SHINGLE)
    names = sum((hashes[at + k] * _WORD[k] for k in range(SHINGLE)), np.zeros(len(at), np.uint64))
    row = words.row[at]
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for k in range(SHINGLE - 1):
            has = counts[few] > k
            short[has] += hashes[words.first[few[has]] + k] * _WORD[k]
        names = np.concatenate((names, short + counts[few].astype(np.uint64)))
        row = np.concatenate((row, few))
    names = mix(names)
    one = distinct_in_rows(row, names)
    return row[one], names[one], len(counts)


def sketches(docs: DataFrame) -> DataFrame:
    """id, tag, n_shingles, a 128-bit name of the set in two columns, and the minhashes (32 bits of each)."""

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, names, n = shingle_sets(piece.column("text"))
        sizes = np.bincount(row, minlength=n)
        filled = np.flatnonzero(sizes)
        begin = (np.cumsum(sizes) - sizes)[filled]
        low = np.zeros((n, len(_FLIP)), np.uint32)
        named = np.zeros((2, n), np.uint64)
        if len(filled):
            for j, (flip, times) in enumerate(zip(_FLIP, _TIMES, strict=True)):
                low[filled, j] = np.minimum.reduceat((names ^ flip) * times, begin) >> np.uint64(32)
            for j, salt in enumerate((1, 2)):
                named[j, filled] = np.add.reduceat(mix(names + np.uint64(salt)), begin)
        minima = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(_FLIP), pa.int32()), pa.array(low.view(np.int32).ravel()))
        columns = [*(piece.column(c) for c in ("doc_id", "tag")), pa.array(sizes), *(pa.array(x.view(np.int64)) for x in named), minima]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "n_shingles", "set_a", "set_b", "minima"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, tag bigint, n_shingles bigint, set_a bigint, set_b bigint, minima array<int>"
    return map_arrow(docs.select("doc_id", row_tag().alias("tag"), "text"), step, schema)


def _half_equal(side: int, agree: Column) -> Column:
    """Number, from 1, of the first half in which two nodes agree; 0 if none."""
    begins = [(side * HALVES + i) * _PER_HALF for i in range(HALVES)]
    equal = [reduce(lambda x, y: x & y, [F.get(agree, F.lit(k + x)) for x in range(_PER_HALF)]) for k in begins]
    return F.array_position(F.array(*equal), True)


def buckets(nodes: DataFrame) -> DataFrame:
    """key, i, j (halves of the table), node, hub (the key's smallest node): for keys of two or more nodes."""
    halves = []
    for side in range(2):
        for i in range(HALVES):
            k = (side * HALVES + i) * _PER_HALF
            parts = [F.get("minima", F.lit(k + x)) for x in range(_PER_HALF)]
            halves.append(F.struct(F.lit(side).cast("byte").alias("side"), F.lit(i).cast("byte").alias("i"), F.xxhash64(F.lit(k), *parts).alias("half")))
    halves = nodes.select("node", F.explode(F.array(*halves)).alias("h")).select("node", "h.*")
    several = written(halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half"))
    sides = halves.join(several, "half", "left_semi").groupBy("node").agg(
        *(F.collect_list(F.when(F.col("side") == s, F.struct("i", "half"))).alias(f"side{s}") for s in range(2))
    )
    pairs = sides.select("node", F.explode("side0").alias("x"), "side1").select("node", "x", F.explode("side1").alias("y"))
    keyed = written(pairs.select(F.xxhash64("x.half", "y.half").alias("key"), F.col("x.i").alias("i"), F.col("y.i").alias("j"), "node"))
    several = written(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1").select("key", "hub"))
    return written(keyed.join(several, "key"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs a, b whose full sets are similar enough."""
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, "text_a")):
            n = batch.num_rows
            column = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")])
            row, names, _ = shingle_sets(column)
            sizes = np.bincount(row, minlength=2 * n)
            both = np.bincount(np.sort(_common(row % max(n, 1), names)), minlength=n)
            near = 100 * both >= SIMILAR * (sizes[:n] + sizes[n:] - both)
            yield batch.select(["a", "b"]).filter(pa.array(near & (both > 0)))

    # One text of each pair travels with it; the other side holds each text once.
    met = pairs.join(right, "b").join(left, "a")
    return written(met.select("a", "b", "text_a", "text_b").mapInArrow(step, "a bigint, b bigint"))


def _common(pair: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The pair of each shingle that both its texts have."""
    order = np.lexsort((names, pair))
    p, v = pair[order], names[order]
    return p[1:][(p[1:] == p[:-1]) & (v[1:] == v[:-1])]


def _contested(tables: DataFrame, roots: DataFrame, **about: Column) -> DataFrame:
    """Rows of buckets that hold nodes of more than one component, with the component as ``label``, and what is asked about each bucket."""
    labelled = written(tables.join(roots, "node", "left").select("key", "i", "j", "node", F.coalesce("root", "node").alias("label")))
    asked = [c.alias(name) for name, c in about.items()]
    several = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), *asked).where("low < high")
    return labelled.join(written(several.drop("low", "high")), "key")


def _links(nodes: DataFrame, texts: DataFrame, tables: DataFrame) -> DataFrame:
    """Node and root of each component, from links that are confirmed on full sets. What is known of components goes on as their stars."""
    stars = tables.where("node > hub").groupBy(F.col("node").alias("b")).agg(F.min("hub").alias("a"))
    tried = written(stars.select("a", "b"))
    roots = components(verified(tried, texts))
    sketch = nodes.select("node", "n_shingles", "minima")
    for turn in range(STAR_ROUNDS):
        hub = F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)), F.col("node"), F.col("label")))
        met = _contested(tables, roots, hub=hub).where(F.col("label") != F.col("hub.label"))
        pairs = met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"), "node").distinct()
        rated = _rated(pairs.join(tried, ["a", "b"], "left_anti"), sketch)
        best = rated.groupBy("node").agg(F.max(F.struct("agreed", "a", "b")).alias("best")).select("best.a", "best.b").distinct()
        best = written(best)
        roots, tried = components(_stars(roots).union(verified(best, texts))), tried.union(best)
    open_rows = written(_contested(tables, roots, n=F.count("*")))
    few, many = open_rows.where(F.col("n") <= FEW).drop("n"), open_rows.where(F.col("n") > FEW).select("key", "node", "label")
    rest = written(_single_pairs(few, sketch).join(tried, ["a", "b"], "left_anti"))
    return components(_stars(roots).union(verified(rest, texts)).union(_block_links(many, texts)))


def _stars(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("root").alias("a"), F.col("node").alias("b"))


def _block_links(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between nodes of different components that share a bucket of more than FEW: enough of them to join what is linked.

    Nodes of one family, those whose buckets lead to the same smallest node, are cut into blocks of about BLOCK. Two blocks are compared if
    some bucket holds nodes of both, each such pair of blocks in a task of its own, on full sets. A row is made for each node of a pair of blocks
    and for each link of a spanning forest, none for a pair of nodes.
    """
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"))
    families = written(rows.join(hubs, "key").groupBy("node").agg(F.min("hub").alias("family"), F.first("label").alias("label")))
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("blocks")))
    blocks = written(families.join(sizes, "family").select("node", "label", block.alias("block")))
    in_bucket = written(rows.select("key", "node").join(blocks, "node").select("key", "block").distinct())
    one, other = (in_bucket.select("key", F.col("block").alias(c)) for c in ("one", "two"))
    pairs = written(one.join(other, "key").where("one <= two").select("one", "two").distinct())
    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    members = sides.join(blocks, "block").join(texts, "node")

    def compare(group: pa.Table) -> pa.Table:
        row, names, n = shingle_sets(pa.concat_arrays(group.column("text").chunks))
        nodes, sizes = group.column("node").to_numpy(), np.bincount(row, minlength=n)
        first = (group.column("block").to_numpy() == group.column("one").to_numpy()) | (group.column("one").to_numpy() == group.column("two").to_numpy())
        inner = group.column("one")[0].as_py() == group.column("two")[0].as_py()
        _, alike = np.unique(group.column("label").to_numpy(), return_inverse=True)
        _, head = np.unique(alike, return_index=True)
        root = head[alike].tolist()  # nodes of one component are joined from the start

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        forest: list[tuple[int, int]] = []
        order = np.argsort(names, kind="stable")
        order = order[first[row[order]]]
        known, holder = names[order], row[order]
        begins = np.searchsorted(row, np.arange(n + 1))
        for z in range(n) if inner else np.flatnonzero(~first):
            mine = names[begins[z] : begins[z + 1]]
            low = np.searchsorted(known, mine)
            times = np.searchsorted(known, mine, side="right") - low
            held = holder[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())]
            both = np.bincount(held, minlength=n)
            both[z] = 0
            for x in np.flatnonzero((both > 0) & (100 * both >= SIMILAR * (sizes + sizes[z] - both))):
                if find(int(x)) != find(int(z)):
                    root[find(int(x))] = find(int(z))
                    forest.append((int(min(nodes[x], nodes[z])), int(max(nodes[x], nodes[z]))))
        return pa.table({"a": pa.array([p[0] for p in forest], pa.int64()), "b": pa.array([p[1] for p in forest], pa.int64())})

    return written(members.groupBy("one", "two").applyInArrow(compare, "a bigint, b bigint"))


def _single_pairs(open_rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that share a bucket of few nodes, each from the first table in which it meets."""
    rows = written(open_rows.join(sketch, "node"))
    x, y = (rows.select("key", "i", "j", *(F.col(c).alias(c + s) for c in ("node", "label", "n_shingles", "minima"))) for s in ("_a", "_b"))
    agree = F.zip_with("minima_a", "minima_b", lambda p, q: p == q)
    fits = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & _may_link("n_shingles_a", "n_shingles_b")
    first = (_half_equal(0, agree) == F.col("l.i") + 1) & (_half_equal(1, agree) == F.col("l.j") + 1)
    pairs = x.alias("l").join(y.alias("r"), (F.col("l.key") == F.col("r.key")) & fits & first)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _may_link(n_a: str, n_b: str) -> Column:
    """Sets of too different sizes cannot be similar enough. Minhashes that disagree prove nothing and drop no pair."""
    return 100 * F.least(n_a, n_b) >= SIMILAR * F.greatest(n_a, n_b)


def _rated(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    for c in ("a", "b"):
        pairs = pairs.join(sketch.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("minima").alias(f"minima_{c}")), c)
    agreed = F.size(F.filter(F.zip_with("minima_a", "minima_b", lambda p, q: p == q), lambda e: e))
    return pairs.withColumn("agreed", agreed).where(_may_link("n_a", "n_b")).select("a", "b", "node", "agreed")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, tag, n_shingles, component_id, and ``leads``: whether the row is the one that stands for its component."""
    docs = docs.select("doc_id", row_tag().alias("tag"), "text")
    found = written(sketches(docs))
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("tag"))).alias("pick")
    sets = found.where("n_shingles > 0").groupBy("set_a", "set_b").agg(pick, F.first("n_shingles").alias("n_shingles"), F.first("minima").alias("minima"))
    nodes = written(sets.withColumn("node", F.monotonically_increasing_id()))
    tables = buckets(nodes)
    wanted = tables.select("node").distinct().join(nodes.select("node", "pick"), "node").select("node", F.col("pick.doc_id").alias("d"), F.col("pick.tag").alias("t"))
    texts = written(docs.join(wanted, docs.doc_id.eqNullSafe(wanted.d) & (docs.tag == wanted.t)).select("node", "text"))
    roots = _links(nodes, texts, tables)
    rooted = nodes.join(roots, "node", "left").select("set_a", "set_b", "pick", F.coalesce("root", "node").alias("root"))
    rooted = written(rooted)
    leaders = written(rooted.groupBy("root").agg(F.min("pick").alias("leader")))
    named = written(rooted.join(leaders, "root").select("set_a", "set_b", "leader"))
    met = found.select("doc_id", "tag", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    alone = F.col("n_shingles") == 0
    return met.select(
        "doc_id",
        "tag",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("leader.doc_id")) & (F.col("tag") == F.col("leader.tag")))).alias("leads"),
    )


@under_plain_names
def keep_leaders(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns; of equal rows with equal doc_id one stays. Empty texts all stay."""
    own_id, own_tag, size, row = free_names(docs, "own_id", "own_tag", "size", "row")
    judged = near_duplicates(docs).where("leads").groupBy("doc_id", "tag").agg(F.max("n_shingles").alias(size))
    judged = judged.withColumnsRenamed({"doc_id": own_id, "tag": own_tag})
    met = docs.join(judged, docs["doc_id"].eqNullSafe(judged[own_id]) & (row_tag() == judged[own_tag]))
    met = met.withColumn(row, F.row_number().over(Window.partitionBy(own_id, own_tag).orderBy(size)))
    return met.where((F.col(size) == 0) | (F.col(row) == 1)).select(*(docs[c] for c in docs.columns))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Exact, and for small tables only: all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	

]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT r, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
    SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b USING (s) JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
    WHERE a.r <> b.r GROUP BY a.r, b.r HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
    SELECT r, r AS other FROM docs UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other
), roots AS (
    SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.other GROUP BY reach.r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN roots USING (r) LEFT JOIN sizes USING (r)
"""
