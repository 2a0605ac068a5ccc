"""Silver: rows of the current load that passed their contract and whose parents passed too.

All frames handed to these functions hold one load only (``of_load``), so the load id never has
to travel as a join key: parents and children cannot come from different loads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.bitmaps import row_set, rows_in, rows_not_in
from ledgerlake.schemas import LINEAGE, SOURCE_ROW
from ledgerlake.session import stored

CONFORMED_TABLES = ("customers", "products", "promotions", "orders", "order_items", "returns")


def current_load(runs: DataFrame) -> DataFrame:
    """The latest succeeded load: one row."""
    return (
        runs.where(F.col("status") == "succeeded")
        .orderBy(F.desc("completed_at"), F.desc("started_at"), F.desc("load_id"))
        .limit(1)
        .select("load_id")
    )


def of_load(df: DataFrame, load_id: str) -> DataFrame:
    """Restrict to one load by a literal, which prunes the bronze partitions while planning."""
    column = "_load_id" if "_load_id" in df.columns else "load_id"
    return df.where(F.col(column) == load_id)


def rejected_rows(failures: DataFrame, table: str, fallen: DataFrame | None = None) -> DataFrame:
    """Numbers of the rows that have a finding or are in ``fallen``, as written bitmaps.

    A bit for each row of a table can be broadcast where the numbers of its rejected rows could not: no whole row is shuffled to be
    dropped, whatever share of a table is rejected.
    """
    own = failures.where((F.col("source_table") == table) & F.col("source_row").isNotNull())
    rows = own.select(F.col("source_row").alias(SOURCE_ROW))
    return row_set(rows if fallen is None else rows.unionByName(fallen.select(SOURCE_ROW)), SOURCE_ROW)


def passing(staged: DataFrame, failures: DataFrame, table: str, fallen: DataFrame | None = None) -> DataFrame:
    """Rows without a finding of their own, and none at all after a table-level finding; without the rows of ``fallen`` too.

    Two separate anti joins keep the number of the bitmap an equi-join key. Table-level findings are bounded by the number of columns.
    """
    whole = failures.where((F.col("source_table") == table) & F.col("source_row").isNull()).select(F.col("load_id").alias("_load_id"))
    kept = rows_not_in(staged, SOURCE_ROW, rejected_rows(failures, table, fallen))
    return kept.join(F.broadcast(whole), "_load_id", "left_anti")


def int_customers(stg: DataFrame, failures: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "customers"), stg)


def int_products(stg: DataFrame, failures: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "products"), stg)


def int_promotions(stg: DataFrame, failures: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "promotions"), stg)


def int_orders(stg: DataFrame, failures: DataFrame, fallen: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "orders", fallen), stg)


def int_order_items(stg: DataFrame, failures: DataFrame, fallen: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "order_items", fallen), stg)


def int_returns(stg: DataFrame, failures: DataFrame, fallen: DataFrame) -> DataFrame:
    return _ordered(passing(stg, failures, "returns", fallen), stg)


def int_promotion_assignments(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    promoted = orders.where(F.col("promotion_id").isNotNull())
    return promoted.join(promotions.select("promotion_id"), "promotion_id").select(
        "order_id", "promotion_id", *LINEAGE
    )


def _ordered(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*like.columns)


# --- rejections ----------------------------------------------------------------------------------

# Fixed values: (table, key, parent, rule, reason) of the cascade rules.
CASCADES = (
    ("orders", "customer_id", "customers", "customer_not_accepted", "customer parent was rejected during conformance"),
    ("orders", "promotion_id", "promotions", "promotion_not_accepted", "promotion parent was rejected during conformance"),
    ("order_items", "order_id", "orders", "order_not_accepted", "order parent was rejected during conformance"),
    ("order_items", "product_id", "products", "product_not_accepted", "product parent was rejected during conformance"),
    ("returns", "line_id", "order_items", "order_item_not_accepted", "order-item parent was rejected during conformance"),
)
#: Tables with parents, after their parents.
CHILDREN = tuple(dict.fromkeys(table for table, *_ in CASCADES))


def lost_keys(
    parent: str, key: str, staged: DataFrame, failures: DataFrame, accepted: DataFrame, fallen: DataFrame | None
) -> DataFrame:
    """Keys of a parent table that only rows not accepted have, written: mostly few, and so broadcast to the children.

    What is looked up are the rows that failed, by their numbers. The keys of accepted rows never cross a shuffle.
    """
    rows = rejected_rows(failures, parent, fallen)
    rejected = rows_in(staged.select(key, SOURCE_ROW).where(F.col(key).isNotNull()), SOURCE_ROW, rows)
    keys = stored(rejected.select(key).distinct())
    namesakes = accepted.select(key).join(keys, key, "left_semi")
    return stored(keys.join(namesakes, key, "left_anti"))


def cascaded(
    table: str, staged: dict[str, DataFrame], failures: DataFrame, accepted: dict[str, DataFrame], fallen: dict[str, DataFrame]
) -> DataFrame:
    """Rows of a table that fall only because a parent was not accepted, once for each such parent, written.

    A row whose parent is nowhere in the load has a foreign-key finding of its own. So a row without findings lost its parent if
    the parent is one of those not accepted, or if the parents failed as a whole. ``fallen`` are these rows of the parents.
    """
    parts = []
    for child, key, parent, rule, reason in CASCADES:
        if child != table:
            continue
        lost = lost_keys(parent, key, staged[parent], failures, accepted[parent], fallen.get(parent))
        whole = failures.where((F.col("source_table") == parent) & F.col("source_row").isNull())
        failed = whole.agg(F.count("*")).scalar() > 0
        rows = staged[table].select(key, "_load_id", "_source_file", SOURCE_ROW)
        if key == "promotion_id":
            rows = rows.where(F.col(key).isNotNull())
        orphans = rows.where(~failed).join(lost, key, "left_semi").select(*rows.columns)
        orphans = orphans.unionByName(rows.where(F.col(key).isNull() | failed)).drop(key)
        kept = passing(orphans, failures, table)
        parts.append(kept.withColumns({"rule_code": F.lit(rule), "reason": F.lit(reason)}))
    return stored(reduce(DataFrame.unionByName, parts))


def _rejection(table: str, rule: Column, reason: Column) -> list[Column]:
    return [
        F.col("_load_id").alias("load_id"),
        F.lit(table).alias("source_table"),
        F.col(SOURCE_ROW).alias("source_row"),
        F.col("_source_file").alias("source_file"),
        rule.alias("rule_code"),
        reason.alias("reason"),
    ]


def _reason() -> Column:
    return F.coalesce(
        F.col("failure_case"), F.concat(F.col("column_name"), F.lit(" failed "), F.col("check_name"))
    )


def direct_rejections(staged: dict[str, DataFrame], failures: DataFrame) -> DataFrame:
    """Findings as rejections.

    A row-level finding names one row of one file and needs no lookup: the audit table carries
    both, and the load that wrote it wrote the row. A table-level finding fans out to all rows
    of its table; those are bounded by the number of columns and hence broadcast.
    """
    by_row = failures.where(
        F.col("source_row").isNotNull() & F.col("source_table").isin(*CONFORMED_TABLES)
    ).select(
        "load_id", "source_table", "source_row", "source_file", F.col("check_name").alias("rule_code"), _reason().alias("reason")
    )
    parts = [by_row]
    for table in CONFORMED_TABLES:
        whole = failures.where((F.col("source_table") == table) & F.col("source_row").isNull()).select(
            F.col("load_id").alias("_load_id"), "check_name", "column_name", "failure_case"
        )
        parts.append(
            staged[table]
            .select("_load_id", SOURCE_ROW, "_source_file")
            .join(F.broadcast(whole), "_load_id")
            .select(*_rejection(table, F.col("check_name"), _reason()))
        )
    return reduce(DataFrame.unionByName, parts)


def int_rejected_records(
    staged: dict[str, DataFrame],
    failures: DataFrame,
    accepted: dict[str, DataFrame],
    fallen: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Direct findings, plus rows that fell only because a parent was not accepted: ``fallen``, where they are known already."""
    fallen = dict(fallen or {})
    parts = [direct_rejections(staged, failures)]
    for table in CHILDREN:
        if table not in fallen:
            fallen[table] = cascaded(table, staged, failures, accepted, fallen)
        parts.append(fallen[table].select(*_rejection(table, F.col("rule_code"), F.col("reason"))))
    return reduce(DataFrame.unionByName, parts)
