"""Token ids in Parquet list columns.

The writer deals documents out by ranges of doc_id, sorts, encodes and writes one file per range, with columns doc_id, n_tokens,
ids (dictionary encoded, delta where the dictionary grows too large), part (the file) and in_file (ids before the document in its
file). Row groups and pages are small and carry column and offset indexes, so a reader that wants a range of doc_ids, or metadata only,
skips the pages of all others. Where a file begins in the whole is the sum over the files before it, one number per file.

The default tokenizer never joins what white space separates, and drops the white space. So a batch is encoded by its distinct words,
each once, and the ids of every text are put together from them; a test holds this against encoding whole texts. A tokenizer that
normalizes or splits in any other way, or whose added tokens such words could hide, is found out on loading and encodes whole texts.

Defined results: NULL and empty texts give the end id alone. Documents are ordered by doc_id, NULL first, then by a hash of the
text; repeated rows are encoded each. Texts of any length are encoded whole, each in one task. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents, folder, pieces, row_tag, small_batches
from ledgerlake.llm.words import Text, Words

END_ID = 2
#: Distinct words, and distinct parts of words, whose ids a Python worker remembers; then it starts anew.
REMEMBERED = 1 << 19

FORMAT = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: What the tokenizer treats alike wherever it stands in a word: runs of ASCII letters, and runs of signs.
_PLAIN = re.compile(r"[!-&(-/:;=-~]+")
_RUNS = re.compile(r"[a-z]+|[^a-z]+")


# How a tokenizer file must normalize and split for words to be encoded apart.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def splits_by_words(spec: dict) -> bool:
    """Whether the tokenizer of this file gives a text the ids of its words, and a plain word those of its runs."""
    plain_model = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
    hidden = [
        t for t in spec["added_tokens"]
        if _PLAIN.fullmatch(t["content"]) or t["content"].split() != [t["content"]] or t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"]
    ]
    return spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _PRE_TOKENIZER and plain_model and not hidden


class Encoder:
    """Encodes pieces of texts word by word where the tokenizer allows it; remembers the ids of words and of their parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.by_words = splits_by_words(json.load(file))
        self.forget()

    def forget(self) -> None:
        self.parts: dict[str, list[int]] = {}
        self.hashes, self.offsets, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _ids(self, words: list[str]) -> list[list[int]]:
        """The ids of each word: plain ones from their parts, the others from the tokenizer as a whole."""
        found: list[list[int] | None] = []
        whole = []
        parts, tokenize = self.parts, self.tokenizer.model.tokenize
        for word in words:
            if not _PLAIN.fullmatch(word):
                whole.append(len(found))
                found.append(None)
                continue
            ids: list[int] = []
            for part in _RUNS.findall(word.lower()):
                known = parts.get(part)
                if known is None:
                    known = parts[part] = [t.id for t in tokenize(part)]
                ids = ids + known if ids else known
            found.append(ids)
        encoded = self.tokenizer.encode_batch_fast([words[i] for i in whole], add_special_tokens=False)
        for i, e in zip(whole, encoded, strict=True):
            found[i] = e.ids
        return found

    def _learn(self, words: Words, hashes: np.ndarray) -> None:
        """Adds the words that are new, keeping the hashes sorted."""
        unique, first = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.hashes, unique)
        known = (at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == unique) if len(self.hashes) else np.zeros(len(unique), bool)
        unique, first = unique[~known], first[~known]
        if not len(unique):
            return
        data = words.text.data.tobytes()
        lists = self._ids([data[b:e].decode() for b, e in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)])
        sizes = np.concatenate((np.diff(self.offsets), np.fromiter(map(len, lists), np.int64, len(lists))))
        flat = np.concatenate((self.ids, np.fromiter(chain.from_iterable(lists), np.uint32)))
        everything = np.concatenate((self.hashes, unique))
        order = np.argsort(everything, kind="stable")
        begins = np.cumsum(sizes) - sizes
        self.hashes, sizes = everything[order], sizes[order]
        self.ids = flat[_spans(begins[order], sizes)]
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and their offsets."""
        if not self.by_words:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            lists = [np.array([*e.ids, END_ID], np.uint32) for e in found]
            return np.concatenate([np.zeros(0, np.uint32), *lists]), np.cumsum([0, *map(len, lists)])
        words = Words.of(Text.of(texts))
        hashes = words.hashes()
        if max(len(self.hashes), len(self.parts)) > REMEMBERED:
            self.forget()
        self._learn(words, hashes)
        at = np.searchsorted(self.hashes, hashes)
        begins, sizes = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
        n = len(words.counts)
        per_text = np.bincount(words.row, sizes, n).astype(np.int64) + 1
        offsets = np.concatenate(([0], np.cumsum(per_text)))
        ids = np.full(offsets[-1], END_ID, np.uint32)
        inside = np.ones(offsets[-1], bool)
        inside[offsets[1:] - 1] = False
        ids[inside] = self.ids[_spans(begins, sizes)]
        return ids, offsets


@cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each span, one after the other."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begins - (total - sizes), sizes)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Writes the files below ``path``; file names ascend with doc_id."""
    spark, place = docs.sparkSession, tokenizer or default_tokenizer()
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(place), 0
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            ids, offsets = encoder.encode(piece.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
            columns = [piece.column("doc_id"), pa.array(np.diff(offsets)), lists, piece.column("part"), pa.array(offsets[:-1] + before)]
            before += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "part", "in_file"])

    kind, ranges = dict(docs.dtypes)["doc_id"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", row_tag().alias("tag"), "text").repartitionByRange(ranges, "doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    encoded = dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids array<int>, part int, in_file bigint"
    )
    encoded.write.options(**FORMAT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. A reader that leaves ids out reads only the metadata columns."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    begins = sizes.select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("begin"))
    # One row per file.
    return files.join(F.broadcast(begins), "part").select("doc_id", (F.col("begin") + F.col("in_file")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """Adds ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of the ids."""
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, ends = lists.flatten().to_numpy().astype("<u4", copy=False), np.cumsum(pc.list_value_length(lists).to_numpy())
            sums = [zlib.crc32(flat[b:e]) for b, e in zip((0, *ends[:-1]), ends, strict=True)] if len(ends) else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def encoded(docs: DataFrame) -> DataFrame:
    """Writes the documents to a new place in the shared folder and reads them back."""
    path = folder(docs.sparkSession)
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path)


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksums(encoded(documents(spark, sf_dir)))
