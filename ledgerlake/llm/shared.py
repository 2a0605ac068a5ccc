"""Written intermediate tables, Arrow batch sizes, row identity."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import fit_shuffles, work_dir

#: Text a Python task handles at a time. Whole texts are never cut, so one longer text is a piece of its own.
PIECE_BYTES = 2 << 20

_FOLDERS: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = work_dir(spark)
    return f"{_FOLDERS[app]}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder: lineage ends here, and lost executors cost nothing."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; shuffles and ranges of the session are sized by them."""
    fit_shuffles(spark, f"{sf_dir}/documents.parquet")
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_tag(text: str = "text") -> Column:
    """Tells rows of one doc_id apart by their text; rows equal in both get equal results everywhere."""
    return F.xxhash64(F.col(text))


def under_plain_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For stages that return the columns of their input: runs them under names without dots, which Spark would take for paths into structs."""

    @wraps(stage)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        plain: list[str] = [c for c in docs.columns if "." not in c and "`" not in c]
        taken = {c.lower() for c in plain}
        names = []
        for c in docs.columns:
            if c not in plain:
                c = c.replace(".", "_").replace("`", "_")
                while c.lower() in taken:
                    c = f"_{c}"
                taken.add(c.lower())
            names.append(c)
        return stage(docs.toDF(*names), *args, **kwargs).toDF(*docs.columns)

    return run


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores in front as it takes to be no column's."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        found.append(name)
    return found


def map_arrow(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` over pieces of about PIECE_BYTES of text; ``step`` gets a piece and yields batches."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield from step(piece)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of documents are bounded by bytes as well as by rows; the settings are only ever lowered."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = spark.conf.get(key)
        now = int("".join(c for c in now if c.isdigit()) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > PIECE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def before(df: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over all rows that come earlier in this order.

    Rows are dealt out by ranges of the order and sorted there, so no task sees more than its range. One sum per range, as many
    as there are partitions, gives each range its beginning.
    """
    part, row = f"_{name}_part", f"_{name}_row"
    dealt = df.withColumn(name, amount).repartitionByRange(_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}))
    sums = dealt.groupBy(part).agg(F.sum(name).alias("_sum"))
    begins = sums.select(F.col(part), (F.sum("_sum").over(Window.orderBy(part)) - F.col("_sum")).alias("_begin"))
    running = F.sum(name).over(Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(begins), part).withColumn(name, F.col("_begin") + running - F.col(name)).drop(part, row, "_begin")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
