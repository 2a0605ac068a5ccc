"""SQL of the queries on the damaged batch: the definitions of ``oracle.tables`` over sources with defects."""

from __future__ import annotations

# (table, every how many rows, place, column, value); the same defects as in the package, stated once more.
_DEFECTS = (
    ("customers", 53, 1, "customer_id", "NULL"),
    ("customers", 53, 2, "signup_date", "NULL"),
    ("customers", 53, 3, "home_city", "NULL"),
    ("customers", 53, 4, "segment", "NULL"),
    ("customers", 53, 5, "customer_id", "'C-1'"),
    ("customers", 53, 6, "segment", "'Nobody'"),
    ("customers", 53, 7, "signup_date", "DATE '2099-01-01'"),
    ("products", 53, 1, "product_id", "NULL"),
    ("products", 53, 2, "name", "NULL"),
    ("products", 53, 3, "category", "NULL"),
    ("products", 53, 4, "base_price", "NULL"),
    ("products", 53, 5, "base_cost", "NULL"),
    ("products", 53, 6, "base_price", "0"),
    ("products", 53, 7, "base_cost", "-1"),
    ("products", 53, 8, "base_cost", "base_price + 1"),
    ("products", 53, 9, "product_id", "'P-1'"),
    ("orders", 211, 2, "customer_id", "NULL"),
    ("orders", 211, 3, "order_timestamp", "NULL"),
    ("orders", 211, 4, "channel", "NULL"),
    ("orders", 211, 5, "payment_method", "NULL"),
    ("orders", 211, 6, "channel", "'Fax'"),
    ("orders", 211, 7, "payment_method", "'Barter'"),
    ("orders", 211, 8, "order_timestamp", "TIMESTAMP '2099-01-01'"),
    ("orders", 211, 9, "customer_id", "'nobody'"),
    ("orders", 211, 10, "promotion_id", "'PROMO-none'"),
    ("order_items", 211, 2, "order_id", "NULL"),
    ("order_items", 211, 3, "product_id", "NULL"),
    ("order_items", 211, 4, "quantity", "NULL"),
    ("order_items", 211, 5, "unit_price", "NULL"),
    ("order_items", 211, 6, "unit_cost", "NULL"),
    ("order_items", 211, 7, "discount_rate", "NULL"),
    ("order_items", 211, 8, "quantity", "0"),
    ("order_items", 211, 9, "unit_price", "-1"),
    ("order_items", 211, 10, "unit_cost", "0"),
    ("order_items", 211, 11, "unit_cost", "unit_price + 1"),
    ("order_items", 211, 12, "discount_rate", "1.5"),
    ("order_items", 211, 13, "order_id", "'none'"),
    ("order_items", 211, 14, "product_id", "'none'"),
    ("returns", 53, 1, "return_id", "NULL"),
    ("returns", 53, 2, "line_id", "NULL"),
    ("returns", 53, 3, "return_date", "NULL"),
    ("returns", 53, 4, "returned_quantity", "NULL"),
    ("returns", 53, 5, "reason", "NULL"),
    ("returns", 53, 6, "returned_quantity", "0"),
    ("returns", 53, 7, "reason", "'Lost'"),
    ("returns", 53, 8, "returned_quantity", "100000"),
    ("returns", 53, 9, "return_date", "DATE '1990-01-01'"),
    ("returns", 53, 10, "line_id", "'none'"),
    ("returns", 53, 11, "return_date", "DATE '2099-01-01'"),
    ("returns", 53, 12, "return_id", "'R-1'"),
    ("promotions", 7, 1, "discount_policy", "1.5"),
    ("promotions", 7, 2, "end_date", "start_date - 10"),
    ("promotions", 7, 3, "promotion_type", "NULL"),
    ("promotions", 7, 4, "start_date", "DATE '2099-01-01'"),
    ("calendar_events", 397, 1, "seasonal_event", "NULL"),
    ("calendar_events", 397, 2, "seasonal_event", "'Monsoon'"),
)
_LOST = {"orders": "order_id", "order_items": "line_id"}


def _damaged(table: str) -> str:
    whens: dict[str, list[str]] = {}
    for t, every, place, column, value in _DEFECTS:
        if t == table:
            whens.setdefault(column, []).append(f"WHEN _source_row % {every} = {place} THEN {value}")
    if table in _LOST:
        whens.setdefault(_LOST[table], []).append("WHEN _source_row = 17 THEN NULL")
    replaced = ", ".join(f"CASE {' '.join(w)} ELSE {c} END AS {c}" for c, w in whens.items())
    return f"SELECT * REPLACE ({replaced}) FROM whole_{table}"


def damaged_tables(tables: dict[str, str]) -> dict[str, str]:
    """The same definitions with each source behind its damaged version."""
    found: dict[str, str] = {}
    for name, sql in tables.items():
        if name.startswith("src_"):
            found[f"whole_{name.removeprefix('src_')}"] = sql
            found[name] = _damaged(name.removeprefix("src_"))
        else:
            found[name] = sql
    return found


#: Queries that run on the damaged batch too, as ``damaged_<name>``.
QUERIES = (
    "contract_not_null", "contract_allowed", "contract_positive", "contract_range", "contract_cross_field", "contract_findings", "contract_summary",
    "contract_accepted", "validation_failures", "ingestion_audit", "int_customers", "int_products", "int_promotions", "int_orders", "int_order_items",
    "int_returns", "int_rejected_records", "check_layers", "check_item_values", "check_item_parents", "check_return_quantities", "mart_executive",
)
