"""Content fingerprint of a batch, independent of partitioning and row order on disk."""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import SOURCE_ROW, SOURCE_TABLES, SourceTables


def table_digest(df: DataFrame, table: str) -> DataFrame:
    """One row: structure, row count and two order-free combinations of 64-bit row hashes.

    A row's hash covers its position, so exchanging two rows changes the digest. Each hash is
    taken over values and NULL flags, as ``xxhash64`` alone skips NULL columns.
    """
    columns = [c for c in df.columns if c != SOURCE_ROW]
    cells = [F.col(c) for c in [SOURCE_ROW, *columns]] + [F.col(c).isNull() for c in columns]
    structure = ";".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    hashed = df.select(F.xxhash64(*cells).alias("h"))
    return hashed.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("string").alias("hash_xor"),
    ).select(F.lit(table).alias("source_table"), F.lit(structure).alias("structure"), "*")


def batch_digest(batch: SourceTables) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_digest(batch[t], t) for t in SOURCE_TABLES])


def source_fingerprint(batch: SourceTables) -> str:
    """Hex digest over the seven one-row table digests."""
    rows = {row["source_table"]: row for row in batch_digest(batch).collect()}
    text = "\x1f".join(str(value) for t in SOURCE_TABLES for value in rows[t])
    return sha256(text.encode()).hexdigest()
