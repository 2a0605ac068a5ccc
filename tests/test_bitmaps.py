"""Sets of numbers as bitmaps, whether broadcast or shuffled."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import bitmaps

NUMBERS = [0, 1, 7, 8, 4095, 32767, 32768, 32775, 10**12 + 5]


@pytest.fixture(params=[bitmaps.MOST_BITMAPS, 0], ids=["broadcast", "shuffled"])
def most(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(bitmaps, "_join", lambda df, number, maps, how: df.join(maps, bitmaps._holds(number), how))
    return request.param


def test_row_sets_are_exact(spark, most):
    chosen = spark.createDataFrame([(n,) for n in [*NUMBERS, *NUMBERS, None]], "n bigint")
    near = sorted({m for n in NUMBERS for m in range(max(0, n - 9), n + 10)})
    df = spark.createDataFrame([(n,) for n in [*near, None]], "n bigint")
    numbers = bitmaps.row_set(chosen.where("n IS NOT NULL"), "n")
    assert sorted(r.n for r in bitmaps.rows_in(df, "n", numbers).collect()) == NUMBERS
    others = [r.n for r in bitmaps.rows_not_in(df, "n", numbers).collect()]
    assert None in others and sorted(n for n in others if n is not None) == [n for n in near if n not in NUMBERS]


def test_a_filter_loses_no_key_and_most_others(spark, most):
    keys = spark.range(1000).select(F.concat(F.lit("L-"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    df = spark.range(11000).select(F.concat(F.lit("L-"), "id").alias("k"), "id")
    left = bitmaps.maybe_in(df, "k", keys)
    assert left.where("id < 1000").count() == 1000
    assert left.where("id >= 1000").count() < 2000
    assert bitmaps.maybe_in(df, "k", keys.limit(0)).count() == 0


def test_keys_of_other_types_are_not_judged(spark):
    df = spark.createDataFrame([("007",), ("8",)], "k string")
    assert bitmaps.maybe_in(df, "k", spark.createDataFrame([(7,)], "k bigint")).count() == 2
