"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time settings the plans in this package are written for. Partition counts start high
# and AQE coalesces them, so one value serves a laptop sample and a large cluster alike.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more (pre-aggregated) shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Written layers are mostly keys of digits, which zstd halves and snappy does not.
    "spark.sql.parquet.compression.codec": "zstd",
}


# Fixed when a session starts. Plans here are built from many small expressions; recording the
# Python line of each one costs more than building it.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(
    app_name: str = "ledgerlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Put the run-time settings on a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process on one machine, may fall back to a temporary folder.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="ledgerlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


_STEPS: dict[str, str] = {}


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read from a table below the shared folder.

    Lineage ends there, Spark knows the table's true size, and what a plan decides once (row numbers, ranges) stays as it is.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _STEPS:
        _STEPS[application] = f"{work_dir(spark)}/ledgerlake/{application}/steps"
    path = f"{_STEPS[application]}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a key and a few columns that take some 10 MB once broadcast, Spark's usual bound.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame) -> DataFrame:
    """A table to look up in, kept from being broadcast where its rows are many.

    Keys in order take so little room in a file that its size, by which Spark chooses, is a hundredth of what the driver would build and send.
    """
    return df.hint("merge") if df.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS else df


# How ``fit_to_input`` cuts: bytes per shuffle partition up to LARGE bytes of input, and the power of the input with which they grow
# beyond; splits of a scan, and the bounds of one.
PARTITION_BYTES = 64 << 20
LARGE, GROWTH = 1 << 40, 0.6
SPLITS = 100_000
MIN_SPLIT, MAX_SPLIT = 128 << 20, 1 << 30


def input_bytes(spark: SparkSession, path: str) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(hadoop_path).getLength()


def shuffle_partitions(size: int) -> int:
    """Partitions for so many bytes of input.

    About 64 MB of compressed columns each leaves room for decoding and for rows that several operators widen; AQE merges
    those that turn out small. Beyond 1 TB partitions grow, to 1 GB at 100 TB (some 100,000 of them), because the driver
    keeps a size for each pair of map task and partition.
    """
    return int(size / (PARTITION_BYTES * max(1.0, size / LARGE) ** GROWTH))


def fit_shuffles(spark: SparkSession, path: str) -> int:
    """Raises the number of shuffle partitions to what the input asks for, never lowers it; returns it."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, shuffle_partitions(input_bytes(spark, path)))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def fit_to_input(spark: SparkSession, path: str) -> int:
    """Size shuffles and scans by the input; returns the shuffle partition count.

    Scan splits grow from 128 MB to at most 1 GB, to keep the number of
    tasks and of files a load writes in the tens of thousands.
    """
    wanted = fit_shuffles(spark, path)
    split = min(max(MIN_SPLIT, input_bytes(spark, path) // SPLITS), MAX_SPLIT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    return wanted
