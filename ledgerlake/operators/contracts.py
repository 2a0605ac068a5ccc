"""Data contracts: each broken rule becomes a finding row, never an exception.

Findings have the columns ``load_id, source_table, source_row, check_name, column_name,
failure_case``. A finding without a row number concerns, and rejects, the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.bitmaps import maybe_in
from ledgerlake.operators.groups import attach_group_value
from ledgerlake.schemas import SOURCE_ROW, SOURCE_TABLES, TABLES, Field, SourceTables
from ledgerlake.session import stored

FINDING_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("source_row", T.LongType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("failure_case", T.StringType()),
    ]
)

# Type names used in ``dtype('...')`` findings.
DTYPE_NAMES = {
    "str": "str",
    "date": "object",
    "timestamp": "datetime64[ns]",
    "int": "int64",
    "float": "float64",
}
_ACCEPTED_TYPES = {
    "str": (T.StringType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampNTZType, T.TimestampType),
    "int": (T.LongType, T.IntegerType, T.ShortType),
    "float": (T.DoubleType, T.FloatType),
}


@dataclass(frozen=True)
class ValueRule:
    """Rule on one column: a SQL condition over ``{c}``, the batch dates and vocabularies. NULL
    values are not judged."""

    table: str
    name: str
    column: str
    ok: str


@dataclass(frozen=True)
class OrderedPair:
    """Row rule ``low <= high``; judged only where no column of the row is NULL."""

    table: str
    name: str
    low: str
    high: str


@dataclass(frozen=True)
class ForeignKey:
    table: str
    name: str
    column: str
    parent: str
    parent_key: str


_POSITIVE = "{c} > 0"
_UNIT_INTERVAL = "{c} BETWEEN 0 AND 1"
_UNTIL_BATCH_END = "{c} <= {end}"
_WITHIN_BATCH = "CAST({c} AS DATE) BETWEEN {start} AND {end}"

# Rule names, the columns they judge and the bounds they apply.
VALUE_RULES = (
    ValueRule("customers", "signup_date_on_or_before_batch_end", "signup_date", _UNTIL_BATCH_END),
    ValueRule("customers", "segment_allowed", "segment", "{c} IN ({segments})"),
    ValueRule("products", "base_price_positive", "base_price", _POSITIVE),
    ValueRule("products", "base_cost_positive", "base_cost", _POSITIVE),
    ValueRule("orders", "order_timestamp_in_range", "order_timestamp", _WITHIN_BATCH),
    ValueRule("orders", "channel_allowed", "channel", "{c} IN ({channels})"),
    ValueRule("orders", "payment_method_allowed", "payment_method", "{c} IN ({payment_methods})"),
    ValueRule("order_items", "quantity_positive", "quantity", _POSITIVE),
    ValueRule("order_items", "unit_price_positive", "unit_price", _POSITIVE),
    ValueRule("order_items", "unit_cost_positive", "unit_cost", _POSITIVE),
    ValueRule("order_items", "discount_rate_between_zero_and_one", "discount_rate", _UNIT_INTERVAL),
    ValueRule("returns", "return_date_on_or_before_batch_end", "return_date", _UNTIL_BATCH_END),
    ValueRule("returns", "returned_quantity_positive", "returned_quantity", _POSITIVE),
    ValueRule("returns", "return_reason_allowed", "reason", "{c} IN ({return_reasons})"),
    ValueRule("promotions", "promotion_start_date_in_range", "start_date", _WITHIN_BATCH),
    ValueRule("promotions", "promotion_end_date_in_range", "end_date", _WITHIN_BATCH),
    ValueRule("promotions", "discount_policy_between_zero_and_one", "discount_policy", _UNIT_INTERVAL),
    ValueRule("calendar_events", "calendar_date_in_range", "date", _WITHIN_BATCH),
    ValueRule("calendar_events", "season_allowed", "seasonal_event", "{c} IN ({seasons})"),
)
ORDERED_PAIRS = (
    OrderedPair("products", "base_cost_lte_price", "base_cost", "base_price"),
    OrderedPair("order_items", "unit_cost_lte_unit_price", "unit_cost", "unit_price"),
    OrderedPair("promotions", "promotion_start_lte_end", "start_date", "end_date"),
)
FOREIGN_KEYS = (
    ForeignKey("orders", "customer_id_foreign_key", "customer_id", "customers", "customer_id"),
    ForeignKey("orders", "promotion_id_foreign_key", "promotion_id", "promotions", "promotion_id"),
    ForeignKey("order_items", "order_id_foreign_key", "order_id", "orders", "order_id"),
    ForeignKey("order_items", "product_id_foreign_key", "product_id", "products", "product_id"),
    ForeignKey("returns", "line_id_foreign_key", "line_id", "order_items", "line_id"),
)


@dataclass(frozen=True)
class ValidationResult:
    load_id: str
    findings: DataFrame
    summary: DataFrame
    accepted: dict[str, DataFrame]
    fingerprint: str


# --- structure -------------------------------------------------------------------------------


def _typed(df: DataFrame, spec: Field) -> bool:
    return isinstance(df.schema[spec.name].dataType, _ACCEPTED_TYPES[spec.kind])


def usable_fields(df: DataFrame, table: str) -> list[Field]:
    """Declared columns that are present with an accepted type."""
    return [f for f in TABLES[table] if f.name in df.columns and _typed(df, f)]


def structure_findings(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """(check, column, failure case) for each structural defect. Reads the schema, not the rows."""
    declared = {f.name: f for f in TABLES[table]}
    found = [("column_in_dataframe", n, n) for n in declared if n not in df.columns]
    found += [
        ("column_in_schema", n, n) for n in df.columns if n not in declared and n != SOURCE_ROW
    ]
    for name, spec in declared.items():
        if name in df.columns and not _typed(df, spec):
            actual = df.schema[name].dataType
            # A text column in place of dates fails row by row (``date_type``), not as a table.
            if spec.kind == "date" and isinstance(actual, T.StringType):
                continue
            found.append((f"dtype('{DTYPE_NAMES[spec.kind]}')", name, actual.simpleString()))
    return found


# --- rules of one table, in one pass ----------------------------------------------------------


def _text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _batch_values(batch: SourceTables) -> dict[str, str]:
    lists = {name: ", ".join(map(_text, values)) for name, values in vars(batch.vocabulary).items()}
    return {**lists, "start": f"DATE'{batch.start_date}'", "end": f"DATE'{batch.end_date}'"}


@dataclass(frozen=True)
class Judgement:
    """One rule applied to one table, in SQL: when it is broken, and the failing case."""

    check: str
    column: str
    broken: str
    case: str

    @property
    def finding(self) -> str:
        return (
            f"named_struct('check_name', {_text(self.check)}, 'column_name', {_text(self.column)}, "
            f"'failure_case', CAST({self.case} AS STRING))"
        )


def row_rules(df: DataFrame, table: str, batch: SourceTables) -> list[Judgement]:
    """Every rule that needs nothing but the row itself."""
    present, usable = set(df.columns), {f.name for f in usable_fields(df, table)}
    values = _batch_values(batch)
    rules: list[Judgement] = []
    for spec in TABLES[table]:
        if spec.name not in present:
            continue
        c = f"`{spec.name}`"
        if not spec.nullable:
            rules.append(Judgement("not_nullable", spec.name, f"{c} IS NULL", "NULL"))
        if spec.kind == "date" and isinstance(df.schema[spec.name].dataType, T.StringType):
            rules.append(Judgement("date_type", spec.name, f"{c} IS NOT NULL", c))
        for rule in VALUE_RULES:
            if rule.table == table and rule.column == spec.name:
                if spec.name in usable:
                    ok = rule.ok.format(c=c, **values)
                    rules.append(Judgement(rule.name, spec.name, f"coalesce(NOT ({ok}), false)", c))
                elif spec.kind in ("date", "timestamp"):
                    # A value that is no date at all lies in no date range.
                    rules.append(Judgement(rule.name, spec.name, f"{c} IS NOT NULL", c))
    for pair in ORDERED_PAIRS:
        if pair.table == table and {pair.low, pair.high} <= usable:
            broken = f"coalesce(`{pair.low}` > `{pair.high}`, false) AND {_complete_row(df)}"
            case = f"concat('{pair.low}=', `{pair.low}`, ', {pair.high}=', `{pair.high}`)"
            rules.append(Judgement(pair.name, f"{pair.low},{pair.high}", broken, case))
    return rules


def _complete_row(df: DataFrame) -> str:
    return " AND ".join(f"`{n}` IS NOT NULL" for n in df.columns if n != SOURCE_ROW)


def broken_rules(df: DataFrame, rules: list[Judgement]) -> DataFrame:
    """Findings of all rules in one pass; only offending rows build any."""
    any_broken = " OR ".join(f"({rule.broken})" for rule in rules) or "false"
    listed = ", ".join(f"if({rule.broken}, {rule.finding}, NULL)" for rule in rules)
    listed = listed or Judgement("", "", "", "NULL").finding
    return df.where(any_broken).selectExpr(f"{SOURCE_ROW} AS source_row", f"inline(array_compact(array({listed})))")


def row_findings(df: DataFrame, table: str, batch: SourceTables) -> DataFrame:
    """All row-local rules of a table in one scan."""
    return broken_rules(df, row_rules(df, table, batch))


def rule_counts(batch: SourceTables, wanted: Callable[[str], bool]) -> DataFrame:
    """Rows judged and rows failed per row-local rule: one scan per table, no finding is built."""
    parts = []
    for table in SOURCE_TABLES:
        df = batch[table]
        rules = [rule for rule in row_rules(df, table, batch) if wanted(rule.check)]
        if not rules:
            continue
        counts = df.agg(
            F.count("*").alias("n"), *[F.expr(f"count_if({rule.broken}) AS c{i}") for i, rule in enumerate(rules)]
        )
        rows = ", ".join(
            f"named_struct('source_table', '{table}', 'check_name', '{rule.check}', 'column_name', '{rule.column}', "
            f"'checked_rows', n, 'failed_rows', c{i})"
            for i, rule in enumerate(rules)
        )
        parts.append(counts.selectExpr(f"inline(array({rows}))"))
    return reduce(DataFrame.unionByName, parts)


# --- rules across rows and tables --------------------------------------------------------------


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once. Counted map-side first, so a hot key is no burden."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


#: Tables whose repeated keys are written before they are used; the calendar and the promotions are small.
_KEYED = ("customers", "products", "orders", "order_items", "returns")
#: With more repeated hashes than this, all keys are counted as they are.
FEW_REPEATS = 100_000


#: Bits of a hash by which keys are counted first, at least; 64 is all. What 40 leave out shrinks to nothing in a shuffle.
HASH_BITS = 40


def _hash_bits(rows: int) -> int:
    """Bits of which some 30,000 pairs of so many different keys share all by chance, a third of FEW_REPEATS."""
    return min(64, max(HASH_BITS, 2 * rows.bit_length() - 16))


def short_hash(rows: int, *columns: str) -> Column:
    """A hash by which few of so many rows meet others by chance."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - _hash_bits(rows))


def _written_repeats(df: DataFrame, key: str) -> DataFrame:
    """``repeated_keys``, written. Short hashes are counted first; of the keys only those cross a shuffle whose hash repeats."""
    hashed = df.select(key, short_hash(df.count(), key).alias("_hash"))
    repeated = stored(repeated_keys(hashed, "_hash").select("_hash"))
    if repeated.count() > FEW_REPEATS:
        return stored(repeated_keys(df, key))
    return stored(repeated_keys(hashed.join(F.broadcast(repeated), "_hash", "left_semi"), key))


def stored_repeats(batch: SourceTables) -> dict[str, DataFrame]:
    """The repeated keys of the larger tables, written: uniqueness, and guards of lookups, read the same (mostly empty) tables, and
    no row is shuffled to find nothing there."""
    keys = {t: f.name for t in _KEYED for f in TABLES[t] if f.unique and f.name in batch[t].columns}
    return {t: _written_repeats(batch[t], key) for t, key in keys.items()}


def uniqueness_findings(df: DataFrame, key: str, repeats: DataFrame | None = None) -> DataFrame:
    """Every copy of a repeated, non-NULL key."""
    found = repeated_keys(df, key) if repeats is None else repeats
    keyed = df.selectExpr(f"CAST(`{key}` AS STRING) AS `{key}`", SOURCE_ROW).where(f"`{key}` IS NOT NULL")
    known = found.selectExpr(f"CAST(`{key}` AS STRING) AS `{key}`", "copies").where(f"`{key}` IS NOT NULL")
    copies = attach_group_value(keyed, key, known, "copies", "copies").where(F.col("copies").isNotNull())
    return broken_rules(copies, [Judgement("field_uniqueness", key, "true", f"`{key}`")])


def foreign_key_findings(batch: SourceTables, fk: ForeignKey) -> DataFrame:
    """Child rows whose key is absent from the parents of the same batch, valid or not.

    The different keys of each task are looked up, and rows by the keys without parents, written: mostly few, and so broadcast.
    """
    child = batch[fk.table].select(fk.column, SOURCE_ROW).where(f"`{fk.column}` IS NOT NULL")
    parent = batch[fk.parent].selectExpr(f"`{fk.parent_key}` AS `{fk.column}`")
    lost = stored(child.select(fk.column).distinct().join(parent, fk.column, "left_anti"))
    return broken_rules(child.join(lost, fk.column, "left_semi"), [Judgement(fk.name, fk.column, "true", f"`{fk.column}`")])


def _is_unique(df: DataFrame, key: str, repeats: DataFrame | None) -> Column:
    """Whether a key has no repeats at all (repeated NULLs count), as a scalar subquery."""
    found = repeated_keys(df, key) if repeats is None else repeats
    return found.agg(F.count("*")).scalar() == 0


def _line_rule(check: str, value: str, ok: str) -> Judgement:
    case = f"concat('{value}=', {value}, ', line_id=\\'', line_id, '\\'')"
    return Judgement(check, f"{value},line_id", f"_complete AND NOT coalesce({ok}, false)", case)


def return_findings(
    batch: SourceTables,
    quantity: bool = True,
    dates: bool = True,
    repeats: dict[str, DataFrame] | None = None,
    fk: ForeignKey | None = None,
) -> DataFrame:
    """Returns against the ordered line and against the day of its order, in one lookup.

    A line or order that cannot be found offers nothing to compare with, and the rule fails.
    The rules are skipped when the parent key has repeats. That is decided by a scalar subquery
    before the join, so the join never multiplies rows. ``fk``, the key of lines, is judged by the same lookup; where that is skipped,
    by one of its own, whose filters leave nothing to shuffle otherwise.
    """
    unique_lines = _is_unique(batch.order_items, "line_id", (repeats or {}).get("order_items"))
    values = ["returned_quantity"] * quantity + ["return_date"] * dates
    ordered = ["quantity"] * quantity + ["order_id"] * dates
    asked = batch.returns.withColumn("_complete", F.expr(_complete_row(batch.returns)))
    asked = asked.where("line_id IS NOT NULL" if fk else "_complete").where(unique_lines)
    lines = maybe_in(batch.order_items.select("line_id", F.lit(True).alias("_known"), *ordered), "line_id", batch.returns)
    looked_up = asked.select("line_id", SOURCE_ROW, "_complete", *values).join(lines, "line_id", "left")
    rules = [Judgement(fk.name, fk.column, "_known IS NULL", f"`{fk.column}`")] if fk else []
    if quantity:
        rules.append(_line_rule("returned_quantity_lte_ordered", "returned_quantity", "returned_quantity <= quantity"))
    if dates:
        orders_unique = _is_unique(batch.orders, "order_id", (repeats or {}).get("orders"))
        days = batch.orders.selectExpr("order_id", "CAST(order_timestamp AS DATE) AS _ordered_on").where(orders_unique)
        looked_up = looked_up.join(days, "order_id", "left").withColumn("_judged", orders_unique)
        rules.append(
            _line_rule("return_date_on_or_after_order", "return_date", "NOT _judged OR return_date >= _ordered_on")
        )
    found = broken_rules(looked_up, rules)
    if fk:
        repeated = {t: batch[t].where(~unique_lines) for t in (fk.table, fk.parent)}
        found = found.unionByName(foreign_key_findings(batch.replace(**repeated), fk))
    return found


def _has(batch: SourceTables, table: str, *columns: str) -> bool:
    return set(columns) <= {f.name for f in usable_fields(batch[table], table)}


def table_findings(batch: SourceTables, table: str, repeats: dict[str, DataFrame] | None = None) -> DataFrame:
    """All findings of one table (without load id). ``repeats`` are the repeated keys of tables, where they are known already."""
    repeats = repeats or {}
    df = batch[table]
    spark = df.sparkSession
    parts = [row_findings(df, table, batch)]
    structural = structure_findings(df, table)
    if structural:
        rows = [(None, *item) for item in structural]
        parts.append(
            spark.createDataFrame(
                rows, "source_row bigint, check_name string, column_name string, failure_case string"
            )
        )
    for spec in TABLES[table]:
        if spec.unique and spec.name in df.columns:
            parts.append(uniqueness_findings(df, spec.name, repeats.get(table)))
    keys = [fk for fk in FOREIGN_KEYS if fk.table == table and fk.column in df.columns and fk.parent_key in batch[fk.parent].columns]
    if table == "returns" and "line_id" in df.columns and _has(batch, "order_items", "line_id"):
        quantity = _has(batch, "returns", "returned_quantity") and _has(batch, "order_items", "quantity")
        dates = (
            _has(batch, "returns", "return_date")
            and _has(batch, "order_items", "order_id")
            and _has(batch, "orders", "order_id", "order_timestamp")
        )
        if quantity or dates:
            parts.append(return_findings(batch, quantity, dates, repeats, *keys))
            keys = []
    parts += [foreign_key_findings(batch, fk) for fk in keys]
    return reduce(DataFrame.unionByName, parts).withColumn("source_table", F.lit(table))


def find_all(batch: SourceTables, load_id: str) -> DataFrame:
    repeats = stored_repeats(batch)
    found = reduce(DataFrame.unionByName, [table_findings(batch, t, repeats) for t in SOURCE_TABLES])
    return found.withColumn("load_id", F.lit(load_id)).select(*FINDING_SCHEMA.fieldNames())


# --- results -----------------------------------------------------------------------------------


def table_sizes(batch: SourceTables) -> DataFrame:
    counts = [
        batch[t].agg(F.count("*").alias("total_rows")).select(F.lit(t).alias("source_table"), "total_rows")
        for t in SOURCE_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def summarize(batch: SourceTables, findings: DataFrame) -> DataFrame:
    """Per table: total, valid and invalid rows, number of findings."""
    found = findings.groupBy("source_table").agg(
        F.countDistinct("source_row").alias("bad_rows"),
        F.count("*").alias("failure_count"),
        F.max(F.col("source_row").isNull()).alias("table_failed"),
    )
    invalid = F.when(F.col("table_failed"), F.col("total_rows")).otherwise(
        F.coalesce(F.col("bad_rows"), F.lit(0))
    )
    return (
        table_sizes(batch)
        .join(found, "source_table", "left")
        .select(
            "source_table",
            "total_rows",
            (F.col("total_rows") - invalid).alias("valid_rows"),
            invalid.alias("invalid_rows"),
            F.coalesce(F.col("failure_count"), F.lit(0)).alias("failure_count"),
        )
    )


def accepted_rows(df: DataFrame, findings: DataFrame, table: str) -> DataFrame:
    """Rows without findings; none when the table as a whole failed."""
    own = findings.where(F.col("source_table") == table)
    bad_rows = own.where(F.col("source_row").isNotNull()).select(F.col("source_row").alias(SOURCE_ROW))
    whole_table = own.where(F.col("source_row").isNull()).select("check_name").limit(1)
    return df.join(bad_rows, SOURCE_ROW, "left_anti").where(~whole_table.exists())


def validate_sources(batch: SourceTables, load_id: str) -> ValidationResult:
    from ledgerlake.operators.fingerprint import source_fingerprint

    findings = find_all(batch, load_id)
    return ValidationResult(
        load_id=load_id,
        findings=findings,
        summary=summarize(batch, findings),
        accepted={t: accepted_rows(batch[t], findings, t) for t in SOURCE_TABLES},
        fingerprint=source_fingerprint(batch),
    )
