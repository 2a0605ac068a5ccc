"""Quality rules as a ledger of bits: every rule is evaluated once per document, policies are masks over the bits.

``ledger`` keeps the measurements and one failure bit per rule. A policy is a version number and the set of rules that
reject; applying another version, or asking what a rule alone costs, needs the bits only and never the texts again. The pipeline's
stage writes the ledger beside the rows and filters by the stored bits.

Defined results: NULL, empty and blank texts have no words and fail ``few_words``. Repeated rows are judged each on its
own. Other columns of the input play no part, whatever their names; an empty table gives an empty ledger.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake.llm.shared import documents, map_arrow, under_plain_names, written
from ledgerlake.llm.words import Lines, Text, Words, distinct_in_rows, span_hashes

WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters")

#: ``capitals`` judges texts that are written in A-Z for at least half of their signs: a word like NASA says nothing about a text in Cyrillic.
#: Rule i owns bit i; new rules go to the end, so stored ledgers keep their meaning.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 2 * n_words",
    "repeated_lines": "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines",
    "odd_word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "capitals": "2 * n_letters >= word_chars AND n_letters > 0 AND 100 * n_capitals > 60 * n_letters",
}
_NAMES = tuple(RULES)
POLICIES = {1: ("few_words", "repeated_words"), 2: _NAMES}
BASE, CURRENT = 1, 2


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << _NAMES.index(r) for r in rules)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of each text. Repeats are found by 64-bit fingerprints within one text."""
    text = Text.of(texts)
    words, lines = Words.of(text), Lines.of(text)
    n = len(text.offsets) - 1
    points = text.code_points()
    per_row = lambda flags: np.bincount(text.row_of(np.flatnonzero(flags)), minlength=n)
    of_word = lambda values: np.bincount(words.row, values, n).astype(np.int64)

    at = words.windows(WINDOW)
    prints = span_hashes(words.hashes(), at, at + WINDOW)
    covered = np.zeros(len(words.starts) + 1, np.int64)
    again = _repeated(words.row[at], prints)
    np.add.at(covered, at[again], 1)
    np.add.at(covered, at[again] + WINDOW, -1)

    full = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    row, prints = lines.row[full], text.byte_hashes(lines.starts[full], lines.ends[full])
    filled = np.bincount(row, minlength=n)
    capitals = (text.data >= 65) & (text.data <= 90)
    return {
        "n_words": words.counts,
        "word_chars": of_word(points[words.ends] - points[words.starts]),
        "n_symbols": per_row(_SYMBOL[text.data]),
        "n_dup_lines": filled - np.bincount(row[distinct_in_rows(row, prints)], minlength=n),
        "n_repeat_words": of_word(np.cumsum(covered[:-1]) > 0),
        "n_lines": filled,
        "n_capitals": per_row(capitals),
        "n_letters": per_row(capitals | ((text.data >= 97) & (text.data <= 122))),
    }


def _repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places whose (row, value) occurs more than once."""
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    return order[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(order) else order


def ledger(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keys``, the measurements, and ``failed_bits``: bit i is set if rule i of RULES fails."""

    def step(piece: pa.RecordBatch):
        found = measure(piece.column("text"))
        columns = [*(piece.column(k) for k in keys), *(pa.array(found[m], pa.int64()) for m in MEASURES)]
        yield pa.RecordBatch.from_arrays(columns, names=[*keys, *MEASURES])

    schema = StructType([*(docs.schema[k] for k in keys), *(StructField(m, LongType()) for m in MEASURES)])
    return map_arrow(docs.select(*dict.fromkeys((*keys, "text"))), step, schema).withColumn("failed_bits", _bits())


def _bits() -> Column:
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def fails(version: int) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) != 0


def ablation(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it rejects, rejects alone, and that stay if it is taken out. One aggregate, no regrouping."""
    rules = POLICIES[version]
    bad = F.col("failed_bits").bitwiseAND(F.lit(mask(rules)))
    counts = [F.count("*").alias("all")]
    for r in rules:
        bit = mask((r,))
        counts += [
            F.count_if(bad.bitwiseAND(F.lit(bit)) != 0).alias(f"{r}_rejected"),
            F.count_if(bad == bit).alias(f"{r}_alone"),
            F.count_if(bad.bitwiseAND(F.lit(mask(rules) & ~bit)) == 0).alias(f"{r}_kept"),
        ]
    rows = ", ".join(f"'{r}', {r}_rejected, {r}_alone, {r}_kept" for r in rules)
    one = book.select("failed_bits").agg(*counts)
    return one.select(F.expr(f"stack({len(rules)}, {rows}) AS (rule, rejected, rejected_alone, kept_without)"), F.col("all").alias("n_docs"))


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each column ``c`` as ``doc_c``, beside their measurements and bits, written to the shared folder.

    Rows are measured once. Any policy, also a later one, and every ablation come from this table; as rows and bits are stored together,
    applying a policy needs neither the rules nor a join.
    """
    names = _beside(docs.columns)
    return written(ledger(docs.toDF(*names), tuple(names)))


def _beside(columns: list[str]) -> list[str]:
    """Names that no measurement has."""
    return [c if c == "text" else f"doc_{c}" for c in columns]


def kept_rows(book: DataFrame, columns: list[str], version: int = CURRENT) -> DataFrame:
    """The rows of a stored ledger that a policy keeps, under the documents' own names."""
    return book.where(~fails(version)).select(*_beside(columns)).toDF(*columns)


@under_plain_names
def keep_good(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows a policy keeps, with all their columns, by the bits of a stored ledger."""
    return kept_rows(stored_ledger(docs), docs.columns, version)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(documents(spark, sf_dir))
    base = F.col("n_words").isNull() | fails(BASE)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~fails(CURRENT)).alias("kept"), "failed_bits",
    )


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS w FROM docs
), windows AS (
    SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, range(8) AS t(k) GROUP BY r
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)
    WHERE regexp_matches(l, '[^ \t\n\x0B\f\r]') GROUP BY r
), measured AS (
    SELECT r, doc_id, len(w)::BIGINT AS n_words,
        length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
    FROM words
), ledger AS (
    SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        (n_words < 20)::INT + 2 * (100 * coalesce(n_repeat_words, 0) > 30 * n_words)::INT + 4 * (10 * n_symbols > 2 * n_words)::INT
        + 8 * (coalesce(n_lines, 0) >= 4 AND 100 * coalesce(n_dup_lines, 0) > 50 * n_lines)::INT
        + 16 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT
        + 32 * (2 * n_letters >= word_chars AND n_letters > 0 AND 100 * n_capitals > 60 * n_letters)::INT AS failed_bits
    FROM measured LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
    failed_bits = 0 AS kept, failed_bits::BIGINT AS failed_bits
FROM ledger
"""
