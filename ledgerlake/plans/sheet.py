"""The flat-sheet pipeline end to end: clean, write, re-read, derive, analyse, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import cleaning, kpi


@dataclass(frozen=True)
class SheetOutputs:
    result: DataFrame
    cleaned: DataFrame
    log: DataFrame
    report: dict[str, DataFrame]


def writer(spark: SparkSession, root: str) -> cleaning.Stage:
    """A stage that writes each named table below ``root`` and reads it back."""

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    return write


def run_sheet_pipeline(raw: DataFrame, rules: cleaning.CleaningRules, root: str) -> SheetOutputs:
    """Clean and report. Every output is one parquet folder below ``root``."""
    spark = raw.sparkSession
    stage = writer(spark, f"{root}/stages")
    out = writer(spark, root)
    judged = cleaning.judged_sheet(raw, rules, stage)
    log = out(cleaning.cleaning_log(judged), "cleaned/Cleaning_Log")
    cleaned = out(cleaning.cleaned_rows(judged), "cleaned/Cleaned_Data")
    broken = cleaning.postconditions(cleaned, rules).where("violations > 0").collect()
    if broken:
        raise AssertionError("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))
    lines = out(kpi.add_calculated_columns(cleaned), "report/Cleaned_Data")
    tables = {"Summary": kpi.kpi_summary(lines), **kpi.analysis_tables(lines)}
    report = {name: out(table, f"report/{name}") for name, table in tables.items()}
    unreconciled = kpi.reconcile_tables(lines).where("not reconciled").collect()
    if unreconciled:
        raise AssertionError(f"not reconciled: {[r['table_name'] for r in unreconciled]}")
    return SheetOutputs(kpi.run_result(raw, cleaned, lines), cleaned, log, {"Cleaned_Data": lines, **report})
