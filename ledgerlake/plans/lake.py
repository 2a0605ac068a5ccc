"""The lake: append-only bronze with lineage, an audit trail, and written silver and gold tables.

Layout below one root folder on shared storage::

    bronze/<table>/_load_id=<id>/            raw rows of every load, values unchanged
    audit/ingestion_runs/                    one small row per state change of a load
    audit/validation_failures/load_id=<id>/source_table=<t>/
    silver/<model>/<load id>/  gold/<model>/<load id>/

Files cannot be published in one transaction, so a load becomes visible by its last write: the
``succeeded`` row. Readers take rows of succeeded loads only; what a failed load left behind is
never read, and its load id cannot be used again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import cached_property
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.contracts import FINDING_SCHEMA, ValidationResult, summarize
from ledgerlake.operators.fingerprint import source_fingerprint
from ledgerlake.plans import conform, gold, marts
from ledgerlake.plans.staging import STAGING
from ledgerlake.schemas import LINEAGE, SOURCE_ROW, SOURCE_TABLES, SourceTables

CONCURRENT_WRITES = 4
AREAS = ("bronze", "silver", "gold", "audit")

RUN_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_manifest_hash", T.StringType()),
        T.StructField("source_row_count", T.LongType()),
        T.StructField("valid_row_count", T.LongType()),
        T.StructField("invalid_row_count", T.LongType()),
        T.StructField("error_summary", T.StringType()),
    ]
)
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("source_row", T.LongType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("failure_case", T.StringType()),
        T.StructField("recorded_at", T.TimestampNTZType()),
        # Partition columns come last on disk.
        T.StructField("load_id", T.StringType()),
        T.StructField("source_table", T.StringType()),
    ]
)


@dataclass(frozen=True)
class IngestionSummary:
    load_id: str
    source_manifest_hash: str
    status: Literal["succeeded", "skipped"]
    source_row_count: int
    valid_row_count: int
    invalid_row_count: int
    failure_count: int


def check_run(run: dict) -> dict:
    """Constraints of an audit row."""
    counts = [run[c] for c in ("source_row_count", "valid_row_count", "invalid_row_count")]
    if any(c < 0 for c in counts) or counts[1] + counts[2] > counts[0]:
        raise ValueError(f"inconsistent row counts: {counts}")
    done, error = run["completed_at"] is not None, run["error_summary"] is not None
    expected = {"running": (False, False), "succeeded": (True, False), "failed": (True, True)}
    if expected.get(run["status"]) != (done, error):
        raise ValueError(f"inconsistent run state: {run['status']}")
    return run


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._bronze_schemas: dict[str, T.StructType] = {}
        self._fallen: dict[tuple[str, str], DataFrame] = {}

    # --- paths ---------------------------------------------------------------------------------

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def exists(self, path: str) -> bool:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop_path)

    @cached_property
    def _runs_path(self) -> str:
        return self.path("audit", "ingestion_runs")

    @cached_property
    def _failures_path(self) -> str:
        return self.path("audit", "validation_failures")

    def _delete(self, paths: list[str]) -> None:
        for path in paths:
            hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)

    def bootstrap(self) -> None:
        """Create the four areas and the two audit tables; harmless when repeated."""
        for area in AREAS:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(area))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        for path, schema in ((self._runs_path, RUN_SCHEMA), (self._failures_path, FAILURE_SCHEMA)):
            if not self.exists(path):
                self.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)

    # --- audit ---------------------------------------------------------------------------------

    def run_states(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(self._runs_path)

    def runs(self) -> DataFrame:
        """Latest state of every load: a finished state wins over ``running``."""
        others = [c for c in RUN_SCHEMA.fieldNames() if c != "load_id"]
        rank = F.when(F.col("status") == "running", 0).otherwise(1)
        latest = F.max_by(F.struct(*others), F.struct(rank.alias("rank"), F.col("completed_at")))
        return self.run_states().groupBy("load_id").agg(latest.alias("s")).select("load_id", "s.*")

    def succeeded(self) -> DataFrame:
        """Ids of the loads that readers may see, as ``load_id``."""
        return self.runs().where("status = 'succeeded'").select("load_id")

    def _one_succeeded(self) -> str | None:
        row = self.succeeded().first()
        return row["load_id"] if row else None

    def failures(self, load_id: str | None = None) -> DataFrame:
        """Findings of one load, or of all succeeded loads."""
        found = self.spark.read.schema(FAILURE_SCHEMA).parquet(self._failures_path)
        if load_id is None:
            return found.join(self.succeeded(), "load_id", "left_semi")
        return conform.of_load(found, load_id)

    def current_load_id(self) -> str:
        row = conform.current_load(self.runs()).first()
        if row is None:
            raise ValueError("no load has succeeded yet")
        return row["load_id"]

    def _record(self, **run) -> None:
        row = check_run({"completed_at": None, "error_summary": None, **run})
        values = tuple(row[c] for c in RUN_SCHEMA.fieldNames())
        self.spark.createDataFrame([values], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(self._runs_path)

    # --- bronze --------------------------------------------------------------------------------

    def bronze_schema(self, table: str) -> T.StructType | None:
        """Schema fixed by the first succeeded load; None before it."""
        if table not in self._bronze_schemas:
            visible = self._one_succeeded()
            if visible is None:
                return None
            found = self.spark.read.parquet(self.path("bronze", table, f"_load_id={visible}")).schema
            self._bronze_schemas[table] = T.StructType([*found.fields, T.StructField("_load_id", T.StringType())])
        return self._bronze_schemas[table]

    def bronze(self, table: str, load_id: str | None = None) -> DataFrame:
        """Rows of one load, or of all succeeded loads; either way only their folders are read."""
        df = self.spark.read.schema(self.bronze_schema(table)).parquet(self.path("bronze", table))
        if load_id is None:
            return df.join(self.succeeded().withColumnRenamed("load_id", "_load_id"), "_load_id", "left_semi").select(*df.columns)
        return conform.of_load(df, load_id)

    def _append_bronze(
        self, table: str, source: DataFrame, load_id: str, at: datetime, target: T.StructType | None
    ) -> None:
        """Append by name. A column the table does not have, or has with another type, is an error."""
        batch = source.select(
            *[c for c in source.columns if c != SOURCE_ROW],
            F.lit(f"{table}.csv").alias("_source_file"),
            F.col(SOURCE_ROW).cast("bigint"),
            F.lit(at).cast("timestamp_ntz").alias("_ingested_at"),
        )
        if target is not None:
            known = {f.name: f.dataType for f in target if f.name != "_load_id"}
            for column in batch.schema:
                if known.get(column.name) != column.dataType:
                    raise ValueError(
                        f"bronze.{table} cannot take column {column.name} {column.dataType.simpleString()}"
                    )
            batch = batch.select(
                *[
                    F.col(n) if n in batch.columns else F.lit(None).cast(kind).alias(n)
                    for n, kind in known.items()
                ]
            )
        batch.write.mode("overwrite").parquet(self.path("bronze", table, f"_load_id={load_id}"))

    def ingest(self, batch: SourceTables, validation: ValidationResult, load_id: str) -> IngestionSummary:
        """Load one validated batch; the outcome is recorded in the audit tables."""
        self.bootstrap()
        fingerprint = source_fingerprint(batch)
        if validation.load_id != load_id:
            raise ValueError("the validation belongs to another load id")
        if validation.fingerprint != fingerprint:
            raise ValueError("the data changed after it was validated")
        known = self.runs().where(
            (F.col("load_id") == load_id)
            | ((F.col("source_manifest_hash") == fingerprint) & (F.col("status") == "succeeded"))
        )
        known = known.limit(2).collect()
        for run in known:
            if run["status"] == "succeeded" and run["source_manifest_hash"] == fingerprint:
                # The rules need not run again: the earlier load of this content has counted them.
                rows = [run[f"{n}_row_count"] for n in ("source", "valid", "invalid")]
                return IngestionSummary(load_id, fingerprint, "skipped", *rows, self.failures(run["load_id"]).count())
        if known:
            raise ValueError(f"load id already used: {load_id}")

        started = _now()
        run = {"load_id": load_id, "started_at": started, "source_manifest_hash": fingerprint}
        counted = {"source_row_count": 0, "valid_row_count": 0, "invalid_row_count": 0}
        try:
            self._write_failures(validation.findings, load_id)
            outcome = self._summary(load_id, fingerprint, "succeeded", summarize(batch, self.failures(load_id)))
            counted = {c: getattr(outcome, c) for c in counted}
            self._record(**run, **counted, status="running")
            targets = {t: self.bronze_schema(t) for t in SOURCE_TABLES}
            # Independent writes overlap: the tail of one leaves cores for the next.
            with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
                writes = [pool.submit(self._append_bronze, t, batch[t], load_id, started, targets.get(t)) for t in SOURCE_TABLES]
            for write in writes:
                write.result()
        except Exception as error:
            message = str(error) or type(error).__name__
            kept = {**counted, "valid_row_count": 0, "invalid_row_count": 0}
            self._record(**run, **kept, status="failed", completed_at=_now(), error_summary=message)
            self._delete([self.path("bronze", t, f"_load_id={load_id}") for t in SOURCE_TABLES])
            raise
        self._record(**run, **counted, status="succeeded", completed_at=_now())
        return outcome

    def _write_failures(self, findings: DataFrame, load_id: str) -> None:
        (
            findings.select(
                F.concat("source_table", F.lit(".csv")).alias("source_file"),
                "source_row",
                "check_name",
                "column_name",
                "failure_case",
                F.lit(_now()).cast("timestamp_ntz").alias("recorded_at"),
                "source_table",
            )
            .write.mode("overwrite")
            .partitionBy("source_table")
            .parquet(f"{self._failures_path}/load_id={load_id}")
        )

    @staticmethod
    def _summary(load_id, fingerprint, status, per_table: DataFrame) -> IngestionSummary:
        names = ("total_rows", "valid_rows", "invalid_rows", "failure_count")
        totals = per_table.agg(*[F.sum(n).alias(n) for n in names]).first()
        return IngestionSummary(load_id, fingerprint, status, *[int(totals[n]) for n in names])

    # --- silver and gold -----------------------------------------------------------------------

    def staged(self, table: str, load_id: str) -> DataFrame:
        return STAGING[table](self.bronze(table, load_id))

    def save(self, area: str, model: str, load_id: str, df: DataFrame) -> DataFrame:
        path = self.path(area, model, load_id)
        df.write.mode("overwrite").parquet(path)
        return self.table(area, model, load_id)

    def table(self, area: str, model: str, load_id: str) -> DataFrame:
        return self.spark.read.parquet(self.path(area, model, load_id))

    def fallen(self, model: str, load_id: str, accepted: dict[str, DataFrame]) -> DataFrame:
        """Rows of a model that fall with a parent; written once per load, for the model and the rejections. ``accepted`` has the parents."""
        if (load_id, model) not in self._fallen:
            parents = [parent for table, _, parent, *_ in conform.CASCADES if table == model]
            earlier = {p: self.fallen(p, load_id, accepted) for p in parents if p in conform.CHILDREN}
            staged = {t: self.staged(t, load_id) for t in (model, *parents)}
            self._fallen[load_id, model] = conform.cascaded(model, staged, self.failures(load_id), accepted, earlier)
        return self._fallen[load_id, model]

    def conformed(self, model: str, load_id: str, parents: dict[str, DataFrame]) -> DataFrame:
        """One silver model of a load as a lazy plan over bronze, findings and its parents."""
        build = getattr(conform, f"int_{model}")
        fallen = [self.fallen(model, load_id, parents)] if model in conform.CHILDREN else []
        return build(self.staged(model, load_id), self.failures(load_id), *fallen)

    def build_silver(self, load_id: str) -> dict[str, DataFrame]:
        """The conformed tables, parents first, as views: bronze without the rows in the written bitmaps of rejected ones."""
        silver: dict[str, DataFrame] = {}
        for table in conform.CONFORMED_TABLES:
            silver[table] = self.conformed(table, load_id, silver)
        return silver

    def fact_plans(self, load_id: str, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The calendar and both facts as lazy plans. For a reader of few columns only these cross the joins, nothing is written, and sums by
        order follow the join of lines with orders in the same partitions."""
        s = silver
        sold = gold.sold_lines(s["order_items"], s["orders"], s["customers"])
        returned = gold.returned_lines(s["returns"], sold)
        dates = gold.dim_date(self.staged("calendar_events", load_id))
        return {"dim_date": dates, "fact_sales": gold.with_sales_amounts(sold), "fact_returns": gold.with_return_amounts(returned)}

    def build_facts(self, load_id: str, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the calendar and both facts. The written files give Spark true sizes to choose broadcast joins by, and every mart
        starts from one column-pruned scan: readers of amounts need no prices. Differences of amounts are not written; readers compute them."""
        s = silver
        dates = self.save("gold", "dim_date", load_id, gold.dim_date(self.staged("calendar_events", load_id)))
        lines = gold.sold_lines(s["order_items"], s["orders"], s["customers"])
        sold = self.save("gold", "fact_sales", load_id, gold.sales_amounts(lines))
        returned = self.save("gold", "fact_returns", load_id, gold.return_amounts(gold.returned_lines(s["returns"], sold)))
        return {"dim_date": dates, "fact_sales": gold.with_sales_differences(sold), "fact_returns": gold.with_return_differences(returned)}

    def build_outcomes(self, load_id: str, facts: dict[str, DataFrame]) -> DataFrame:
        """Write the order totals, which feed the customer and cohort marts, the latter twice."""
        outcomes = marts.order_outcomes(facts["fact_sales"], facts["fact_returns"], facts["dim_date"])
        return self.save("gold", "order_outcomes", load_id, outcomes)

    def build_gold(self, load_id: str, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        facts = self.build_facts(load_id, silver)
        return {**facts, "order_outcomes": self.build_outcomes(load_id, facts)}


__all__ = ["FINDING_SCHEMA", "LINEAGE", "IngestionSummary", "Lake"]
