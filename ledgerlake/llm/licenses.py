"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into tokens (lower-cased runs of letters and digits), hashed in runs of GRAM tokens, and of each WINNOW
neighbouring hashes the smallest is a fingerprint. An inverted index leads from a fingerprint to templates and places. Any GRAM tokens of
a text found there say where the template would lie; hits that lie alike are one candidate. A candidate is aligned by local dynamic
programming within BAND tokens of that place, so that inserted, missing and changed words are borne. Reported are places
that cover at least the wanted share of a template, the best of those that overlap.

The index and the templates go to each task with the code: their size is that of the given templates. There is no shuffle.

Defined results: NULL and empty texts have no tokens and give no row. Repeated rows are reported each. A NULL doc_id is reported
as NULL. Templates of fewer than GRAM tokens are refused. Empty tables give an empty result; other columns play no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.license_texts import TEMPLATES
from ledgerlake.llm.shared import documents, map_arrow
from ledgerlake.llm.words import Text, Words, span_hashes

GRAM = 3
WINNOW = 3
BAND = 8
MIN_COVERAGE = 0.8
#: Shorter templates are notices whose every word counts: "version 2" must not pass for "version 3". They match completely or not.
NOTICE_TOKENS = 20

_SIGN = np.ones(256, bool)
_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

# Cells of the alignment hold score, matches and start in one number, so that the best is the largest.
_SCORE, _MATCH = 1 << 42, 1 << 21
_STARTS = _MATCH - 1


@dataclass
class Index:
    names: list[str]
    tokens: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words.of(Text.of(texts, lower=True), _SIGN)
    return words, words.hashes()


def build_index(templates: Mapping[str, str]) -> Index:
    names = list(templates)
    words, hashes = _tokens(pa.array([templates[n] for n in names], pa.string()))
    if names and words.counts.min() < GRAM:
        raise ValueError(f"a template needs {GRAM} tokens")
    grams = words.windows(GRAM)
    prints, row = span_hashes(hashes, grams, grams + GRAM), words.row[grams]
    chosen = set()
    for begin in range(len(grams)):  # templates are few
        near = [i for i in range(begin, min(begin + WINNOW, len(grams))) if row[i] == row[begin]]
        chosen.add(min(near, key=lambda i: (int(prints[i]), -i)))
    at = np.array(sorted(chosen, key=lambda i: int(prints[i])), np.int64)
    tokens = [hashes[words.first[i] : words.first[i + 1]] for i in range(len(names))]
    return Index(names, tokens, prints[at], row[at], grams[at] - words.first[row[at]])


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id, license, coverage, n_matched, n_tokens (of the template), start and end (code points of the text)."""
    index = build_index(templates)

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, hashes = _tokens(piece.column("text"))
        found = best_of_overlapping(places(words, hashes, index, min_coverage))
        row, which, matched, begin, end = (np.array([f[k] for f in found], np.int64) for k in range(5))
        points = words.text.code_points()
        base = points[words.text.offsets[row]]
        sizes = np.array([len(index.tokens[t]) for t in which], np.int64)
        columns = [
            piece.column("doc_id").take(pa.array(row)),
            pa.array([index.names[t] for t in which], pa.string()),
            pa.array(matched / np.maximum(sizes, 1)),
            pa.array(matched),
            pa.array(sizes),
            pa.array(points[words.starts[begin]] - base if len(row) else begin),
            pa.array(points[words.ends[end]] - base if len(row) else end),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license", "coverage", "n_matched", "n_tokens", "start", "end"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, license string, coverage double, n_matched bigint, n_tokens bigint, start bigint, end bigint"
    return map_arrow(docs.select("doc_id", "text"), step, schema)


def places(words: Words, hashes: np.ndarray, index: Index, min_coverage: float) -> list[tuple[int, int, int, int, int]]:
    """row, template, matches, first and last token of every aligned candidate that covers enough."""
    grams = words.windows(GRAM)
    prints = span_hashes(hashes, grams, grams + GRAM)
    low, high = np.searchsorted(index.prints, prints), np.searchsorted(index.prints, prints, side="right")
    hit = np.flatnonzero(high > low)
    times = high[hit] - low[hit]
    entry = np.repeat(low[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    gram = np.repeat(grams[hit], times)
    template, row, lies = index.template[entry], words.row[gram], gram - index.place[entry]
    sizes = np.array([len(x) for x in index.tokens])
    reach = np.minimum(BAND, sizes // 2)
    wanted = np.where(sizes < NOTICE_TOKENS, sizes, min_coverage * sizes)
    order = np.lexsort((lies, row, template))
    template, row, lies = template[order], row[order], lies[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (template[1:] != template[:-1]) | (row[1:] != row[:-1]) | (lies[1:] - lies[:-1] > reach[template[1:]])
    begin = np.flatnonzero(fresh)
    found = []
    for t in np.unique(template[begin]):
        some = begin[template[begin] == t]
        matched, first, last = _align(hashes, index.tokens[t], lies[some], words.first[row[some]], words.first[row[some] + 1])
        good = matched >= wanted[t]
        found += zip(row[some][good].tolist(), [int(t)] * int(good.sum()), matched[good].tolist(), first[good].tolist(), last[good].tolist(), strict=True)
    return found


def _align(tokens: np.ndarray, template: np.ndarray, lies: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of a template at each place of ``lies``: matches, first and last token. A match scores 2, a gap or change -1.

    Cell o of template row i stands for text token lies + i + o - band; texts end at ``low`` and ``high``. Short templates have a
    narrow band, so that a notice that follows at once is a place of its own.
    """
    band = min(BAND, len(template) // 2)
    width = 3 * band + 1
    offsets = np.arange(width) - band
    gaps = np.arange(width) * _SCORE
    fresh = np.broadcast_to(np.arange(width), (len(lies), width)).astype(np.int64)
    cells, best, last = fresh.copy(), np.zeros(len(lies), np.int64), np.zeros(len(lies), np.int64)
    for i, token in enumerate(template):
        at = lies[:, None] + i + offsets
        inside = (at >= low[:, None]) & (at < high[:, None])
        equal = inside & (tokens[np.clip(at, 0, len(tokens) - 1)] == token)
        diagonal = np.maximum(cells, fresh + i) + np.where(equal, 2 * _SCORE + _MATCH, -_SCORE)
        missing = np.concatenate((cells[:, 1:], np.zeros((len(lies), 1), np.int64)), axis=1) - _SCORE
        now = np.maximum(np.maximum(diagonal, missing), 0)
        cells = np.maximum.accumulate(now + gaps, axis=1) - gaps  # text tokens the template lacks
        top = np.where(equal, diagonal, 0)
        o = top.argmax(axis=1)
        value = top[np.arange(len(lies)), o]
        better = value > best
        best, last = np.where(better, value, best), np.where(better, lies + i + o - band, last)
    return (best // _MATCH) & (_SCORE // _MATCH - 1), lies + (best & _STARTS) - band, last


def best_of_overlapping(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of places of a text that overlap, the one with most matches, then the shortest, then the first template."""
    kept: list[tuple[int, int, int, int, int]] = []
    taken: dict[int, list[tuple[int, int]]] = {}
    for f in sorted(set(found), key=lambda f: (f[0], -f[2], f[4] - f[3], f[1], f[3])):
        spans = taken.setdefault(f[0], [])
        # Kept spans are disjoint and in order, so only the last that begins before this one ends can overlap it.
        at = bisect_right(spans, f[4], key=lambda span: span[0])
        if at == 0 or spans[at - 1][1] < f[3]:
            spans.insert(at, (f[3], f[4]))
            kept.append(f)
    return sorted(kept, key=lambda f: (f[0], f[3]))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per place of a document that holds a licence text or notice."""
    return scan(documents(spark, sf_dir))
