"""Line dedup: lines that many documents share stay in one of them only.

Two Bloom filters over the hashes of line keys, one of keys seen and one of keys seen by two documents, are filled where
the documents lie. Only lines whose key the second filter claims, the suspected repeats, are shuffled, as text, to be counted exactly
and to choose the document that keeps them. Texts meet the dropped lines in one join.

Defined results: a NULL or empty text is one empty line. Each row is a document, also if rows repeat; rows with the
largest doc_id of a key all keep it. A NULL doc_id is smaller than every other one; if a key occurs under NULL only, it stays.
An empty table gives an empty result, and other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bloom
from ledgerlake.llm.shared import documents, map_arrow, pieces, row_tag, small_batches, written
from ledgerlake.llm.words import Lines, Text, distinct_in_rows

MIN_CHARS = 20
MIN_DOCS = 3
_BLANK = b" \t\n\x0b\x0c\r"


def _keys(texts: pa.Array, min_chars: int) -> tuple[Text, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One of each long key per text: the lower-cased text, row, start, end and hash."""
    text = Text.of(texts, lower=True)
    lines = Lines.of(text)
    starts, ends = lines.stripped()
    points = text.code_points()
    long = np.flatnonzero(points[ends] - points[starts] >= min_chars)
    row, starts, ends = lines.row[long], starts[long], ends[long]
    hashes = text.byte_hashes(starts, ends)
    one = distinct_in_rows(row, hashes)
    return text, row[one], starts[one], ends[one], hashes[one]


def _strings(text: Text, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    data = text.data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))


def repeated_filter(docs: DataFrame, min_chars: int) -> np.ndarray:
    """The filter of keys that two or more documents seem to hold."""
    spark = docs.sparkSession
    small_batches(spark)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
    bits = bloom.bits_for(n_lines)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_keys(piece.column("text"), min_chars)[-1] for batch in batches for piece in pieces(batch, "text"))
        yield from bloom.partial_blocks(found, bits)

    return bloom.merged(docs.select("text").mapInArrow(fill, bloom.BLOCKS), "twice", bits)


def suspects(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, tag and key of each suspected repeat, once per document."""
    field = docs.sparkSession.sparkContext.broadcast(repeated_filter(docs, min_chars))

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, row, starts, ends, hashes = _keys(piece.column("text"), min_chars)
        yes = bloom.contains(field.value, hashes)
        row, keys = pa.array(row[yes]), _strings(text, starts[yes], ends[yes])
        columns = [piece.column("doc_id").take(row), piece.column("tag").take(row), keys]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "key"])

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", row_tag().alias("tag"), "text"), step, f"doc_id {kind}, tag bigint, key string")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines before, n_dropped, and the text that is kept."""
    docs = docs.select("doc_id", "text")
    seen = written(suspects(docs, min_chars))
    # Counted map-side first, so a line of very many documents is a few rows; written, so that the join below can be split.
    repeats = written(seen.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs).select("key", "last"))
    earlier = F.col("last").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
    dropped = seen.join(repeats, "key").where(earlier).groupBy("doc_id", "tag").agg(F.collect_set("key").alias("keys"))
    dropped = dropped.withColumnsRenamed({"doc_id": "d", "tag": "t"})
    tagged = docs.withColumn("tag", row_tag())
    met = tagged.join(dropped, tagged.doc_id.eqNullSafe(dropped.d) & (tagged.tag == dropped.t), "left")
    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(met.select("doc_id", "text", "keys"), _rewrite, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_text string")


def _rewrite(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n_lines, n_dropped, kept = [], [], []
    for text, keys in zip(piece.column("text"), piece.column("keys"), strict=True):
        whole = text.as_py() or ""
        if not keys.is_valid:
            n_lines.append(whole.count("\n") + 1)
            n_dropped.append(0)
            kept.append(whole)
            continue
        lines, gone = whole.split("\n"), {k.encode() for k in keys.as_py()}
        rest = [x for x in lines if x.encode().strip(_BLANK).lower() not in gone]
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(rest))
        kept.append("\n".join(rest))
    columns = [piece.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept_text"])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
    SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM docs
), keyed AS (
    SELECT r, doc_id, line, i, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), repeats AS (
    SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT r, doc_id, key FROM keyed WHERE length(key) >= 20)
    GROUP BY key HAVING count(*) >= 3
), judged AS (
    SELECT r, k.doc_id, i, line, last IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < last) AS gone
    FROM keyed k LEFT JOIN repeats USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""
