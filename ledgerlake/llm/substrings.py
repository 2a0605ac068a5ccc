"""Substring dedup by recompression: runs of 50 words that an earlier document holds are removed.

Texts are parsed in rounds. A round joins runs of one symbol, then pairs of a left and a right symbol; which is which is a
bit of the symbol's name. A name is a 64-bit hash of what it stands for, hence global: equal substrings get the same
interior symbols in every document, and no table of names has to be exchanged between rounds. Symbols of round k (from 0)
span at most k + 2 words, and a step changes only the symbols at the ends of a substring, k + 2 words by runs and k + 1 by
pairs. So the symbols that lie at least MARGIN words inside a window are the same, by place and by name, in every copy of the window.

A last round names blocks: the symbols that lie wholly in the CORE words from a border on, named by the names of these symbols. Among the
blocks inside a window the one with the smallest name is its anchor. Names of anchors that documents share reveal candidates:
they are put into a Bloom filter, and windows whose anchor it holds are verified, grouped by 64 bits of the names of all their
interior symbols and of the words at both ends, and by 32 bits of their 50 words alone. A window goes if the smallest document
that holds it is smaller than its own.

Defined results: NULL and empty texts have no words. Rows of one doc_id are never "smaller" than each other, and repeated
rows get equal results. A NULL doc_id is smaller than every other. Texts of any length are taken whole, each in one task. An
empty table gives an empty result; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bloom
from ledgerlake.llm.shared import documents, map_arrow, pieces, row_tag, small_batches, written
from ledgerlake.llm.words import Text, Words, mix, span_hashes

WINDOW = 50
ROUNDS = 2
#: Words of a block of symbols.
CORE = 20
#: The words that all rounds together can change at an end of a window.
MARGIN = sum(2 * k + 3 for k in range(ROUNDS))
#: Places in a window at which a block can begin that ends inside it. Symbols are shorter, so one of the places is a border.
REACH = WINDOW - 2 * MARGIN - CORE + 1
assert ROUNDS + 1 <= REACH

_NONE = np.iinfo(np.uint64).max
_NULL_ID = -(2**63)


def recompress(names: np.ndarray, row: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """First words and names of the symbols after all rounds; ``names`` and ``row`` are those of the words."""
    names = names.copy()
    at, span = np.arange(len(names)), np.ones(len(names), np.int64)
    for k in range(rounds):
        most = k + 2
        begins = np.ones(len(names), bool)
        begins[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(begins)
        times = np.diff(begin, append=len(names))
        joined = (times > 1) & (times * span[begin] <= most)
        names[begin[joined]] = mix(names[begin[joined]] * np.uint64(3) + times[joined].astype(np.uint64))
        span[begin[joined]] *= times[joined]
        keep = begins | ~np.repeat(joined, times)
        names, span, at, row = names[keep], span[keep], at[keep], row[keep]

        left = (mix(names + np.uint64(2 * k + 1)) & np.uint64(1)) == 0
        first = np.flatnonzero(left[:-1] & ~left[1:] & (row[:-1] == row[1:]) & (span[:-1] + span[1:] <= most))
        names[first] = mix(mix(names[first]) * np.uint64(5) + names[first + 1])
        span[first] += span[first + 1]
        keep = np.ones(len(names), bool)
        keep[first + 1] = False
        names, span, at, row = names[keep], span[keep], at[keep], row[keep]
    return at, names


@dataclass
class Parsed:
    """Words of some texts, their hashes, and the symbols they are parsed into: ``at`` (first words) and ``names``."""

    words: Words
    hashes: np.ndarray
    at: np.ndarray
    names: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Parsed:
        words = Words.of(Text.of(texts))
        hashes = words.hashes()
        return cls(words, hashes, *recompress(hashes, words.row))

    def borders(self) -> np.ndarray:
        """For each word, and the end of the last, the number of symbols that begin before it."""
        begins = np.zeros(len(self.hashes) + 1, np.int64)
        begins[self.at + 1] = 1
        return np.cumsum(begins)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all windows, the word at which each one's anchor begins, and the anchor's name."""
        ends = np.append(self.at, len(self.hashes))
        inside = np.flatnonzero(self.at + CORE <= self.words.first[self.words.row[self.at] + 1])
        # Symbols from this border to the last border that is at most CORE words on.
        last = np.searchsorted(ends, self.at[inside] + CORE, side="right") - 1
        value = np.full(len(self.hashes), _NONE, np.uint64)
        value[self.at[inside]] = span_hashes(self.names, inside, last)
        begin = self.words.windows(WINDOW)
        place = _lowest(value, begin + MARGIN, REACH)
        return begin, place, value[place]

    def keys(self, begin: np.ndarray) -> np.ndarray:
        """64 bits of each window: the names of the symbols inside it, and the words between these and its ends."""
        before = self.borders()
        first, last = before[begin + MARGIN], before[begin + WINDOW - MARGIN + 1] - 1
        left, right = self.at[first], self.at[last]
        ends = span_hashes(self.hashes, begin, left), span_hashes(self.hashes, right, begin + WINDOW)
        return mix(mix(mix(ends[0]) + span_hashes(self.names, first, last)) + ends[1])


def _lowest(value: np.ndarray, begin: np.ndarray, reach: int) -> np.ndarray:
    """Place of the smallest of the ``reach`` values from each begin on, by minima over widths that double."""
    place, width = np.arange(len(value)), 1
    while 2 * width <= reach and len(value) > width:
        ahead = np.concatenate((place[width:], np.repeat(place[-1:], width)))
        place = np.where(value[ahead] < value[place], ahead, place)
        width *= 2
    a, b = place[begin], place[begin + reach - width]
    return np.where(value[b] < value[a], b, a)


def shared_anchors(docs: DataFrame) -> DataFrame:
    """Names of anchors that stand in documents of two or more ids."""

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parsed = Parsed.of(piece.column("text"))
        _, place, names = parsed.anchors()
        one = np.flatnonzero(np.diff(place, prepend=-1))
        ids = piece.column("id").take(pa.array(parsed.words.row[place[one]]))
        yield pa.RecordBatch.from_arrays([pa.array(names[one].view(np.int64)), ids], names=["name", "id"])

    found = map_arrow(docs.select("id", "text"), step, "name bigint, id bigint")
    return found.groupBy("name").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("name")


def shared_filter(docs: DataFrame) -> np.ndarray:
    names = written(shared_anchors(docs))
    bits = bloom.bits_for(names.count())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from bloom.partial_blocks((b.column("name").to_numpy().view(np.uint64) for b in batches), bits)

    return bloom.merged(names.mapInArrow(fill, bloom.BLOCKS), "once", bits)


#: Windows a task gathers before it sets aside those it knows to be repeats.
FLUSH_WINDOWS = 1 << 20
_PLACED = "part int, key bigint, more int, id bigint, tag bigint, at int, ats array<int>"


def candidate_windows(docs: DataFrame) -> DataFrame:
    """Windows whose anchor is shared: part (of the anchor), hashes of symbols and words, id, tag, number of the first word.

    Where a task holds a window in several documents, only the smallest goes on as such a row; of the others it is already
    known that they go, and one row per document carries their places in ``ats``.
    """
    field = docs.sparkSession.sparkContext.broadcast(shared_filter(docs))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            held.append(_found(piece, field.value))
            size += len(held[-1][0])
            if size >= FLUSH_WINDOWS:
                yield from _reduced(held)
                held, size = [], 0
        yield from _reduced(held)

    return docs.select("id", "tag", "text").mapInArrow(run, _PLACED)


def _found(piece: pa.RecordBatch, field: np.ndarray) -> tuple[np.ndarray, ...]:
    parsed = Parsed.of(piece.column("text"))
    words = parsed.words
    begin, _, names = parsed.anchors()
    shared = bloom.contains(field, names)
    begin, part = begin[shared], (names[shared] & np.uint64(0xFFFFF)).astype(np.int32)
    key = parsed.keys(begin).view(np.int64)
    more = (span_hashes(parsed.hashes, begin, begin + WINDOW, 0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    row = words.row[begin]
    ids, tags = (piece.column(c).to_numpy()[row] for c in ("id", "tag"))
    return part, key, more, ids, tags, (begin - words.first[row]).astype(np.int32)


def _reduced(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    part, key, more, ids, tags, at = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((ids, more, key))
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > _first_id(key[order], more[order], ids[order])
    first = ~later
    n = int(first.sum())
    rows = [part[first], key[first], more[first], ids[first], tags[first], at[first]]
    yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.nulls(n, pa.list_(pa.int32()))], names=_names(_PLACED))
    known_ids, known_tags, ats = _by_document(ids[later], tags[later], at[later])
    n = len(known_ids)
    spread = (mix(known_ids.view(np.uint64)) & np.uint64(0xFFFFF)).astype(np.int32)
    rows = [spread, np.zeros(n, np.int64), np.zeros(n, np.int32), known_ids, known_tags, np.zeros(n, np.int32)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, rows), ats], names=_names(_PLACED))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _first_id(key: np.ndarray, more: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of the first row of each row's window; rows come sorted."""
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
    return ids[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))] if len(key) else ids


def _by_document(ids: np.ndarray, tags: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    order = np.lexsort((at, tags, ids))
    ids, tags, at = ids[order], tags[order], at[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    begin = np.flatnonzero(fresh)
    offsets = np.concatenate((begin, [len(ids)])).astype(np.int32)
    return ids[begin], tags[begin], pa.ListArray.from_arrays(pa.array(offsets), pa.array(at))


def repeated_windows(windows: DataFrame) -> DataFrame:
    """i, t and places of windows that a smaller document holds.

    Equal windows have one anchor, so they meet in one partition; sorted, the first row of a window has its smallest id, and one pass
    needs no memory for a group. A task has sent a window once for each FLUSH_WINDOWS of its own, however many of its documents hold it.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = None, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= FLUSH_WINDOWS // 8:
                last = yield from decide(held, last)
                held, size = [], 0
        yield from decide(held, last)

    def decide(held: list[pa.RecordBatch], last: tuple | None) -> Iterator[pa.RecordBatch]:
        if not held:
            return last
        table = pa.Table.from_batches(held).combine_chunks()
        known = table.column("ats").is_valid()
        rows = table.filter(known)
        yield from rows.select(["id", "tag", "ats"]).rename_columns(["i", "t", "ats"]).to_batches()
        rows = table.filter(pc.invert(known))
        key, more, ids, tags, at = (rows.column(c).to_numpy() for c in ("key", "more", "id", "tag", "at"))
        if not len(key):
            return last
        low = _first_id(key, more, ids)
        if last:
            low = np.where((key == last[0]) & (more == last[1]), last[2], low)
        later = low < ids
        found = _by_document(ids[later], tags[later], at[later])
        yield pa.RecordBatch.from_arrays([*map(pa.array, found[:2]), found[2]], names=["i", "t", "ats"])
        return key[-1], more[-1], low[-1]

    dealt = windows.repartition("part").sortWithinPartitions("part", "key", "more", "id")
    return dealt.mapInArrow(judge, "i bigint, t bigint, ats array<int>")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, and the text of the words that are kept."""
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), row_tag().alias("tag"), "text")
    gone = repeated_windows(candidate_windows(docs)).groupBy("i", "t").agg(F.flatten(F.collect_list("ats")).alias("gone"))
    met = docs.join(gone, (docs.id == gone.i) & (docs.tag == gone.t), "left").select("doc_id", "text", "gone")
    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(met, _rewrite, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string")


def _rewrite(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = Words.of(Text.of(piece.column("text")))
    gone = piece.column("gone").fill_null(pa.scalar([], piece.column("gone").type))
    begin = gone.flatten().to_numpy() + np.repeat(words.first[:-1], np.diff(gone.offsets.to_numpy()))
    change = np.zeros(len(words.starts) + WINDOW + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + WINDOW, -1)
    keep = np.cumsum(change[: len(words.starts)]) == 0
    counts = words.counts
    kept = np.bincount(words.row[keep], minlength=len(counts))
    columns = [piece.column("doc_id"), pa.array(counts), pa.array(counts - kept), words.joined(keep)]
    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), windows AS (
    SELECT r, doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS g
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
), later AS (
    SELECT r, i FROM windows JOIN (SELECT g, min(coalesce(doc_id, -9223372036854775808)) AS low FROM windows GROUP BY g) USING (g)
    WHERE low < doc_id
), edges AS (
    SELECT r, i AS p, 1 AS d FROM later UNION ALL SELECT r, i + 50, -1 FROM later
), words AS (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), depth AS (
    SELECT r, p, word, sum(coalesce(d, 0)) OVER (PARTITION BY r ORDER BY p) AS cover
    FROM words LEFT JOIN (SELECT r, p, sum(d) AS d FROM edges GROUP BY r, p) USING (r, p)
), kept AS (
    SELECT r, count(*) FILTER (cover > 0) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (cover = 0) AS t FROM depth GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
