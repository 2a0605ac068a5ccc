"""Sets of numbers as bitmaps, one row for each 32,768 numbers: small enough to be broadcast where rows or keys are too many.

``rows_in`` and ``rows_not_in`` are exact. ``maybe_in`` drops rows whose key is surely not among others: a join of the rest, which must
follow, finds the same rows, and fewer of them cross its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import stored

#: Numbers of one bitmap are told apart by 15 bits; bitmaps of Spark have 4 kB.
_LOW = 15
#: More bitmaps (64 MB) are not broadcast but shuffled, as the rows they are held against.
MOST_BITMAPS = 1 << 14
#: Bits for each key; with more keys than fit into all bitmaps a filter says "maybe" more often.
BITS = 12


def _bitmaps(df: DataFrame, number: Column) -> DataFrame:
    parts = df.select(F.shiftright(number, _LOW).alias("_high"), number.bitwiseAND((1 << _LOW) - 1).alias("_low"))
    return stored(parts.groupBy("_high").agg(F.bitmap_construct_agg("_low").alias("_bits")))


def _holds(number: Column) -> Column:
    """Whether the bitmap beside a number has its bit."""
    low = number.bitwiseAND((1 << _LOW) - 1)
    byte = F.substring(F.col("_bits"), (F.shiftright(low, 3) + 1).cast("int"), F.lit(1))
    found = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), low.bitwiseAND(7).cast("int"))
    return (F.shiftright(number, _LOW) == F.col("_high")) & (found == 1)


def _join(df: DataFrame, number: Column, bitmaps: DataFrame, how: str) -> DataFrame:
    few = bitmaps.count() <= MOST_BITMAPS
    return df.join(F.broadcast(bitmaps) if few else bitmaps, _holds(number), how)


def row_set(rows: DataFrame, column: str) -> DataFrame:
    """The numbers in a column, not NULL and not negative, as bitmaps, written."""
    return _bitmaps(rows, F.col(column).cast("bigint"))


def rows_in(df: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    return _join(df, F.col(column).cast("bigint"), numbers, "left_semi")


def rows_not_in(df: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    return _join(df, F.col(column).cast("bigint"), numbers, "left_anti")


def _filter(key: str, keys: DataFrame, bits_each: int) -> tuple[Column, DataFrame]:
    """The place of a key in a filter, and the filter: a bit for the place of each key, as bitmaps."""
    known = keys.select(key).where(F.col(key).isNotNull())
    bits = min(max(known.count() * bits_each, 1), MOST_BITMAPS << _LOW)
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    return place, _bitmaps(known, place)


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` but for those whose key is in no row of ``keys``; some of these stay too. Keys of different types are not judged."""
    if df.schema[key].dataType != keys.schema[key].dataType:
        return df
    place, bitmaps = _filter(key, keys, BITS)
    return _join(df, place, bitmaps, "left_semi")


def parted(df: DataFrame, key: str, keys: DataFrame, bits_each: int = BITS) -> tuple[DataFrame, DataFrame]:
    """All rows of ``df`` in two parts: those whose key may be in ``keys``, and those whose key surely is not. Both columns are of one type."""
    place, bitmaps = _filter(key, keys, bits_each)
    return _join(df, place, bitmaps, "left_semi"), _join(df, place, bitmaps, "left_anti")
