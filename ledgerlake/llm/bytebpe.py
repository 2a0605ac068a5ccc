"""Byte-level BPE by a tree: halves are encoded apart, neighbours are joined by encoding a growing window around their border anew.

Two neighbouring tokens are *stable* if the merges, run on their bytes alone, give just these two. A row of tokens is the encoding
of its bytes exactly if all its neighbours are stable:

* If the merges on the whole ever crossed a border of the row, take the first merge that does, between tokens a and b. Until then
  all merges lay inside tokens, and those inside a and b came in the same order as on the bytes of a and b alone, lowest rank first
  and the left one of equals. So on a and b alone the same merge crosses, and the two are not stable.
* The other way round, a merge that crosses on a and b alone is also open on the whole, and would come before any that spoils it.

So a window that begins and ends with tokens stable beside those outside it proves the whole row right, and nothing outside has to
be looked at. Encoding is thereby a monoid: rows of tokens under that join. A match of the pattern that is a token itself is that
token, as the reference library has it. Leaves are some bytes long, so a match of n bytes takes O(n log n) steps, one of a single
repeated letter O(n log^2 n). Decoding joins the bytes of tokens up the same kind of tree.

What counts as letter, number and space is asked of the tiktoken library once, so that versions of Unicode cannot differ.

Defined results: NULL and empty texts have no ids, and decode to no bytes. A NULL ids array decodes to no bytes. Texts of any
length, and single matches of any length, are encoded whole. Ties of rank fall to the left. Repeated rows are encoded each, in no
order; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents, map_arrow, small_batches
from ledgerlake.llm.words import Text

#: Bytes of a leaf of the encoding tree, tokens of a leaf of the decoding tree.
LEAF, LEAF_TOKENS = 32, 4096
#: Matches, and pairs of tokens, that a Python worker remembers; then it starts anew. Longer matches are not remembered.
REMEMBERED, REMEMBERED_CHARS = 1 << 19, 64
#: Matches of one text that are taken at a time.
AT_A_TIME = 1 << 16
_LAST_OF_PLANE_0 = 0xFFFF


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _members(name: str) -> str:
    """All characters of a class of the pattern, in order, as tiktoken sees them."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    one_byte = {bytes([i]): i for i in range(256)}
    finder = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=one_byte, special_tokens={})
    return finder.decode(finder.encode_ordinary(every))


def _ranges(name: str, last: int) -> str:
    found: list[list[int]] = []
    for c in map(ord, _members(name)):
        if c > last:
            break
        if found and found[-1][1] == c - 1:
            found[-1][1] = c
        else:
            found.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in found)


@cache
def splitter(pattern: str, last: int) -> re.Pattern:
    """The pattern with its classes of characters written out, up to the code point ``last``."""
    names = {name: _ranges(name, last) for name in (r"\p{L}", r"\p{N}", r"\s")}
    name = r"\\p\{[LN]\}|\\s"
    sets = re.sub(r"\[[^\]]*\]", lambda m: re.sub(name, lambda n: names[n[0]], m[0]), pattern)
    sets = sets.replace(r"\S", rf"[^{names[r'\s']}]")
    return re.compile(re.sub(rf"(\[[^\]]*\])|({name})", lambda m: m[1] or f"[{names[m[2]]}]", sets))


class _Remembered(dict):
    """A bounded memory of a function."""

    def __init__(self, function, keep=lambda key: True):
        self.function, self.keep = function, keep

    def __missing__(self, key):
        value = self.function(key)
        if self.keep(key):
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Coder:
    """Encodes matches of the pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.none = max(ranks.values(), default=-1) + 1
        self.of_match = _Remembered(self.encode, lambda match: len(match) <= REMEMBERED_CHARS)
        self.stable = _Remembered(lambda pair: self.merged(pair[0] + pair[1]) == list(pair))

    def encode(self, match: str) -> tuple[int, ...]:
        data = match.encode()
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else tuple(map(self.ranks.__getitem__, self.tree(data)))

    def tree(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.tree(data[:half]), self.tree(data[half:]))

    def joined(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of both, from their encodings."""
        i = j = 1
        while True:
            window = self.merged(b"".join(left[-i:] + right[:j]))
            begins = i == len(left) or self.stable[left[-i - 1], window[0]]
            ends = j == len(right) or self.stable[window[-1], right[j]]
            if begins and ends:
                return left[:-i] + window + right[j:]
            i, j = i if begins else min(2 * i, len(left)), j if ends else min(2 * j, len(right))

    def merged(self, data: bytes) -> list[bytes]:
        """All merges on these bytes: always the pair of lowest rank, of equals the left one."""
        return self._few(data) if len(data) <= LEAF else self._many(data)

    def _few(self, data: bytes) -> list[bytes]:
        get, none = self.ranks.get, self.none
        parts = [data[i : i + 1] for i in range(len(data))]
        open_pairs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while open_pairs and (least := min(open_pairs)) < none:
            at = open_pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del open_pairs[at]
            if at:
                open_pairs[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(open_pairs):
                open_pairs[at] = get(parts[at] + parts[at + 1], none)
        return parts

    def _many(self, data: bytes) -> list[bytes]:
        """With a heap of pairs; a pair whose parts have changed since is passed over."""
        n, get = len(data), self.ranks.get
        end, begin_of_left = list(range(1, n + 1)), list(range(-1, n))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(data[i : i + 2])) is not None]
        heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n and (rank := get(data[i : (stop := end[end[i]])])) is not None:
                heappush(heap, (rank, i, stop))

        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                begin_of_left[stop] = i
            offer(i)
            offer(begin_of_left[i])
        parts, i = [], 0
        while i < n:
            parts.append(data[i : end[i]])
            i = end[i]
        return parts


_CODERS: list[Coder] = []


def _coder(ranks: dict[bytes, int]) -> Coder:
    """Workers outlive tasks, and so does what they remember, as long as the ranks are the same."""
    if not _CODERS or _CODERS[0].ranks is not ranks and _CODERS[0].ranks != ranks:
        _CODERS[:] = [Coder(ranks)]
    _CODERS[0].ranks = ranks
    return _CODERS[0]


def _matches(text: str, split: re.Pattern) -> Iterator[list[str]]:
    if len(text) <= AT_A_TIME:
        yield split.findall(text)
        return
    found = (m.group() for m in split.finditer(text))
    while some := list(islice(found, AT_A_TIME)):
        yield some


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids of each text. The ranks, a table of the size of the vocabulary, are broadcast."""
    wanted = pattern or default_pattern()
    plain, full = splitter(wanted, _LAST_OF_PLANE_0).pattern, splitter(wanted, 0x10FFFF).pattern
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path or default_ranks()))

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        of_match = _coder(ranks.value).of_match
        texts = piece.column("text")
        beyond = bool((Text.of(texts).data >= 0xF0).any())  # four-byte characters
        split = re.compile(full if beyond else plain)
        lists = [
            np.fromiter(chain.from_iterable(chain.from_iterable(map(of_match.__getitem__, some) for some in _matches(text or "", split))), np.int32)
            for text in texts.to_pylist()
        ]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32)))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", "text"), step, f"doc_id {kind}, ids array<int>")


def _concatenated(tokens: pa.Array, ids: pa.Array) -> bytes:
    """Halves are decoded apart and joined; a leaf's bytes lie side by side once its tokens are looked up."""
    if len(ids) > LEAF_TOKENS:
        half = len(ids) // 2
        return _concatenated(tokens, ids[:half]) + _concatenated(tokens, ids[half:])
    if not len(ids):
        return b""
    _, offsets, data = tokens.take(ids).buffers()
    return data.to_pybytes()[: np.frombuffer(offsets, np.int32)[len(ids)]]


def decode(tokens: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """doc_id, ids, and decoded: the bytes of the ids. An id that no token has is an error."""
    small_batches(tokens.sparkSession)
    ranks = read_ranks(ranks_path or default_ranks())
    by_id: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    vocabulary = tokens.sparkSession.sparkContext.broadcast(by_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(vocabulary.value, pa.binary())
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            parts = [_concatenated(table, lists.values[b:e]) for b, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(parts, pa.binary())], names=["doc_id", "ids", "decoded"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(documents(spark, sf_dir))).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
