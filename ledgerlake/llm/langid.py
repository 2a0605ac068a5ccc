"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams by language in one distributed pass over all labelled documents outside the held-out fold; what
reaches the driver is one number per language and hash bucket. The matrix of log-probabilities, BUCKETS rows of one column per
language (128 KB each), is broadcast. A text is a sparse row of n-gram counts, kept as the list of its buckets; a batch is scored by
looking up the matrix at them and adding up by text.

Letters A-Z and the capitals of Latin-1 are lower-cased, other ASCII signs count as spaces.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, as is every text if nothing was learned.
Documents with NULL lang are not learned from. A NULL doc_id is not held out. Ties go to the language that sorts first.
Repeated rows are judged alike; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.shared import documents, map_arrow, pieces, small_batches, written
from ledgerlake.llm.words import Text, mix

GRAMS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Stands for the number of documents of a language.
_DOCUMENTS = -1

_FOLDED = np.arange(0x250, dtype=np.uint32)
_FOLDED[:128] = 32
_FOLDED[97:123] = np.arange(97, 123)
_FOLDED[65:91] = np.arange(97, 123)
_FOLDED[0xC0:0xDF] += 32
_FOLDED[0xD7] = 0xD7


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _grams(text: Text) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of each n-gram within one text, and the text; in order of texts."""
    points = np.frombuffer(text.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    points = np.where(points < len(_FOLDED), _FOLDED[np.minimum(points, len(_FOLDED) - 1)], points).astype(np.uint64)
    sizes = np.diff(text.code_points()[text.offsets])
    row = np.repeat(np.arange(len(sizes)), sizes)
    for n in GRAMS:
        count = len(points) - n + 1
        if count <= 0:
            return
        value = np.full(count, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(0x10FFFF + 2) + points[k : k + count]
        inside = row[:count] == row[n - 1 :]
        yield (mix(value[inside]) >> np.uint64(64 - 15)).astype(np.int64), row[:count][inside]


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the matrix of log-probabilities, its last row the log priors."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        n_docs: dict[str, int] = defaultdict(int)
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            langs, which = np.unique(np.array(piece.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            for lang, n in zip(langs, np.bincount(which), strict=True):
                n_docs[str(lang)] += int(n)
            for bucket, row in _grams(Text.of(piece.column("text"))):
                found = np.bincount(which[row] * BUCKETS + bucket, minlength=len(langs) * BUCKETS)
                for lang, part in zip(langs, found.reshape(len(langs), BUCKETS), strict=True):
                    counts[str(lang)] += part
        for lang, n in n_docs.items():
            some = np.flatnonzero(counts[lang])
            columns = [pa.array([lang] * (len(some) + 1)), pa.array([*some, _DOCUMENTS], pa.int32()), pa.array([*counts[lang][some], n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    found = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    sums = written(found.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = sums.toArrow()
    langs, which = np.unique(np.array(table.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    counts = np.zeros((BUCKETS + 1, len(langs)))
    counts[table.column("bucket").to_numpy(), which] = table.column("n").to_numpy()  # bucket -1 is the last row
    grams = counts[:-1] + SMOOTHING
    logs = np.vstack([np.log(grams / grams.sum(axis=0)), np.log(counts[-1:] / max(counts[-1].sum(), 1))])
    return [str(x) for x in langs], logs.astype(np.float32)


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred and score, the posterior of the predicted language."""
    model = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))

    def step(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = Text.of(piece.column("text"))
        n = piece.num_rows
        sums = np.tile(model.value[:, -1:].astype(np.float64), (1, n))
        for bucket, row in _grams(text):
            for k, column in enumerate(model.value):
                sums[k] += np.bincount(row, column[bucket], n)
        known = _has_letter(text, piece.column("text")) & (len(langs) > 0)
        names, score = np.full(n, UNKNOWN, object), np.zeros(n)
        if langs:
            best = sums.argmax(axis=0)
            names[known] = np.array(langs, object)[best[known]]
            score[known] = 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)[known]
        columns = [piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"), step, schema)


def _has_letter(text: Text, texts: pa.Array) -> np.ndarray:
    ascii_letter = ((text.data | 32) >= 97) & ((text.data | 32) <= 122)
    found = np.bincount(text.row_of(np.flatnonzero(ascii_letter)), minlength=len(texts)) > 0
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
    return found


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, *train(docs))
