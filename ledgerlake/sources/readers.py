"""Reading source tables with a stable 0-based row number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.schemas import FLAT_SCHEMA, SOURCE_ROW

# One row per file; lists of more files than this are joined by shuffle.
BROADCAST_FILES = 100_000


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table plus ``_source_row``, its row's position in the table.

    The scan itself knows each row's place in its file, so no sort or shuffle is needed. With
    several files, taken in path order, a file starts where the earlier ones end; the row
    counts come from the file footers.
    """
    raw = spark.read.parquet(path)
    files = len(raw.inputFiles())
    if files <= 1:
        return raw.select("*", F.col("_metadata.row_index").alias(SOURCE_ROW))
    located = raw.select(
        "*",
        F.col("_metadata.row_index").alias("_in_file"),
        F.col("_metadata.file_path").alias("_file"),
    )
    sizes = raw.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_rows"))
    # One row per file: the ordered window below sees file counts, never data rows.
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    if files <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return (
        located.join(starts, "_file")
        .withColumn(SOURCE_ROW, F.col("_start") + F.col("_in_file"))
        .drop("_file", "_in_file", "_start")
    )


def number_in_file_order(df: DataFrame, scratch: str) -> DataFrame:
    """Add ``_source_row`` in the order of files and lines, for formats without row positions.

    A task reads its splits from front to back, so ids that grow within a task keep the order of lines
    within a split. The rows are written once with their split and id, which a lost executor cannot
    change later; a split then starts where the earlier splits of its file, and earlier files, end.
    """
    (
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
        )
        .write.mode("errorifexists")
        .parquet(scratch)
    )
    placed = df.sparkSession.read.parquet(scratch)
    # One row per split: the ordered window sees splits, never data rows.
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = placed.groupBy("_file", "_block").agg(F.count("*").alias("_rows"), F.min("_pos").alias("_first"))
    starts = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        placed.join(starts, ["_file", "_block"])
        .withColumn(SOURCE_ROW, F.col("_start") + F.col("_pos") - F.col("_first"))
        .drop("_file", "_block", "_pos", "_first", "_start")
    )


def read_flat_csv(spark: SparkSession, path: str, scratch: str) -> DataFrame:
    """Raw order-line sheet from CSV with declared types, rows numbered as they stand; a missing path is an error."""
    raw = spark.read.schema(FLAT_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
    return number_in_file_order(raw, scratch)
