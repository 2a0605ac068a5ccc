"""One SQL statement per registered query, for an independent engine."""

from __future__ import annotations

import re

from ledgerlake.operators.quality import declared_tests
from ledgerlake.sources.shop_tables import SEGMENTS
from ledgerlake.schemas import Vocabulary
from oracle import analyses, damage
from oracle import tables as t

CTE = t.CTE | analyses.TABLES
# Heavy tables that several parts of a statement read.
_SHARED = {"li", "findings", "stg_order_items", "int_orders", "int_order_items", "fact_sales", "fact_returns", "order_totals", "sheet", "parsed", "judged", "sold_lines"}
_SHARED |= analyses.SHARED


def with_tables(final: str, tables: dict[str, str] = CTE) -> str:
    """Prefix a statement with the definitions it needs, directly or through others."""
    needed: set[str] = set()
    queue = [final]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & set(tables) - needed:
            needed.add(name)
            queue.append(tables[name])
    shared = lambda name: name in _SHARED or name.startswith(("src_", "stg_", "int_"))
    used = [f"{name} AS {'MATERIALIZED ' if shared(name) else ''}({tables[name]})" for name in tables if name in needed]
    if not used:
        return final
    own = final.lstrip()
    if own.startswith("WITH "):
        return f"WITH {', '.join(used)},\n{own.removeprefix('WITH ')}"
    return f"WITH {', '.join(used)}\n{final}"


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _counts(rows) -> str:
    """(table, check, column, broken condition) -> rows judged and failed."""
    return _union(
        f"SELECT '{table}' AS source_table, '{check}' AS check_name, '{column}' AS column_name, "
        f"count(*) AS checked_rows, count(CASE WHEN {broken} THEN 1 END) AS failed_rows FROM src_{table}"
        for table, check, column, broken in rows
    )


def _value_counts_of(*suffixes: str) -> str:
    return _counts(
        (table, check, column, f"NOT ({ok.format(c=column)})")
        for table, check, column, ok in t.VALUE_RULES
        if check.endswith(suffixes)
    )


def _named_count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS violations FROM {source}"


def _model_tests(kind: str) -> str:
    parts = []
    for test in declared_tests(Vocabulary(segments=SEGMENTS)):
        if test.test != kind:
            continue
        column, model = test.column, test.model
        if kind == "not_null":
            count = f"SELECT count(*) FROM {model} WHERE ({column}) IS NULL"
        elif kind == "unique":
            count = f"SELECT count(*) FROM (SELECT ({column}) AS k FROM {model} WHERE ({column}) IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        elif kind == "accepted_values":
            values = ", ".join(f"'{v}'" for v in test.values)
            count = f"SELECT count(DISTINCT {column}) FROM {model} WHERE {column} NOT IN ({values})"
        else:
            count = (
                f"SELECT count(*) FROM {model} WHERE {column} IS NOT NULL "
                f"AND {column} NOT IN (SELECT {test.parent_column} FROM {test.parent})"
            )
        label = column.replace("'", "''")
        parts.append(
            f"SELECT '{kind}' AS test_name, '{model}' AS model_name, '{label}' AS column_name, "
            f"'{test.severity}' AS severity, ({count}) AS violations"
        )
    return _union(parts)


def _stamp(table: str) -> str:
    return f"SELECT * REPLACE (strftime(order_timestamp, '%Y-%m-%d %H:%M:%S') AS order_timestamp) FROM {table}"


def _median_text(metric: str, value: str) -> str:
    return f"SELECT '{metric}' AS Metric, CAST({value} AS VARCHAR) AS Value FROM sold_totals"


def _winner(metric: str, table: str, column: str, order: str, where: str = "") -> str:
    return (
        f"SELECT * FROM (SELECT '{metric}' AS Metric, {column} AS Value FROM {table} {where} "
        f"ORDER BY {order}, {column} LIMIT 1)"
    )


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    for table in t.TABLES:
        q[f"stg_{table}"] = f"SELECT * FROM stg_{table}"
    q["stg_orders"] = _stamp("stg_orders")

    q["contract_not_null"] = _counts(
        (table, "not_nullable", column, f"{column} IS NULL") for table, columns in t.NOT_NULL.items() for column in columns
    )
    q["contract_allowed"] = _value_counts_of("_allowed")
    q["contract_positive"] = _value_counts_of("_positive")
    q["contract_range"] = _value_counts_of("_between_zero_and_one", "_in_range", "_on_or_before_batch_end")
    q["contract_cross_field"] = _counts(
        (table, check, f"{low},{high}", f"{low} > {high} AND {t.complete(table)}") for table, check, low, high in t.PAIRS
    )
    q["contract_unique"] = """
SELECT rn AS source_row, 'field_uniqueness' AS check_name, 'line_id' AS column_name, k AS failure_case,
       'order_items by pair' AS source_table
FROM (SELECT rn, 'L-' || l_orderkey || '-' || l_linenumber AS k,
             count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM li) WHERE n > 1
UNION ALL """ + _union(
        f"SELECT _source_row, 'field_uniqueness', '{key}', CAST({key} AS VARCHAR), '{table}' FROM src_{table} "
        f"WHERE {key} IN (SELECT {key} FROM src_{table} GROUP BY {key} HAVING count(*) > 1)"
        for table, key in t.KEYS.items()
    )
    closed = {"orders": "closed_orders", "order_items": "closed_items"}
    q["contract_fk"] = _union(
        t.foreign_key_sql(table, check, column, parent, closed.get(table, f"src_{table}"), closed.get(parent, f"src_{parent}"))
        for table, check, column, parent in t.FOREIGN_KEYS
    )
    plain = "SELECT source_row, check_name, column_name, failure_case FROM ({})"
    q["contract_return_qty"] = plain.format(t.return_quantity_sql("closed_items"))
    q["contract_return_date"] = plain.format(t.return_date_sql("closed_items", "closed_orders"))
    q["contract_findings"] = f"SELECT '{t.LOAD}' AS load_id, * FROM findings"
    q["contract_summary"] = """
SELECT source_table, total_rows, total_rows - coalesce(bad, 0) AS valid_rows, coalesce(bad, 0) AS invalid_rows,
       coalesce(failure_count, 0) AS failure_count
FROM table_sizes LEFT JOIN finding_counts USING (source_table)"""
    q["contract_accepted"] = _union(
        f"SELECT '{table}' AS source_table, count(*) AS accepted, CAST(sum(_source_row) AS BIGINT) AS row_sum, "
        "CAST(sum(CAST(_source_row AS HUGEINT) * _source_row % 1000003) AS BIGINT) AS row_digest "
        f"FROM src_{table} s WHERE NOT EXISTS (SELECT 1 FROM findings f WHERE f.source_table = '{table}' AND f.source_row = s._source_row)"
        for table in t.TABLES
    )
    q["bronze_lineage"] = _union(
        f"SELECT '{t.LOAD}' AS _load_id, '{table}.csv' AS _source_file, count(*) AS row_count, "
        f"min(_source_row) AS first_row, max(_source_row) AS last_row, CAST(0 AS BIGINT) AS rows_without_time FROM src_{table}"
        for table in t.TABLES
    )
    q["validation_failures"] = (
        f"SELECT '{t.LOAD}' AS load_id, source_table || '.csv' AS source_file, * FROM findings"
    )
    q["ingestion_audit"] = f"""
SELECT '{t.LOAD}' AS load_id, 'succeeded' AS status, CAST(sum(total_rows) AS BIGINT) AS source_row_count,
       CAST(sum(total_rows) - sum(coalesce(bad, 0)) AS BIGINT) AS valid_row_count,
       CAST(sum(coalesce(bad, 0)) AS BIGINT) AS invalid_row_count
FROM table_sizes LEFT JOIN finding_counts USING (source_table)"""
    q["current_load"] = f"SELECT '{t.LOAD}' AS load_id, CAST(sum(total_rows) AS BIGINT) AS row_count FROM table_sizes"

    for table in t.CONFORMED:
        q[f"int_{table}"] = f"SELECT * FROM int_{table}"
    q["int_orders"] = _stamp("int_orders")
    for name in (
        "int_promotion_assignments",
        "int_rejected_records",
        "dim_date",
        "dim_customer",
        "dim_product",
        "dim_channel",
        "dim_geography",
        "dim_promotion",
        "dim_payment_method",
        "fact_sales",
        "fact_returns",
        "mart_executive",
        "mart_customer_360",
        "mart_cohort_base",
        "mart_basket_base",
        "mart_forecasting_base",
        *t.GROUPINGS,
    ):
        q[name] = f"SELECT * FROM {name}"

    q["clean_dedup"] = "SELECT * FROM sheet_dedup"
    raw = t.parsed_sql("sheet")
    q["clean_text"] = f"SELECT _source_row, Product, Category, City, Payment_Method FROM ({raw})"
    q["clean_fill_city"] = "SELECT _source_row, City, _city_missing, _city_unknown FROM judged"
    q["clean_fill_payment"] = "SELECT _source_row, Payment_Method, _payment_missing, _payment_unknown FROM judged"
    q["clean_quantity"] = f"SELECT _source_row, Quantity, _bad_quantity FROM ({raw})"
    q["clean_price_median"] = "SELECT * FROM medians"
    q["clean_price_repair"] = "SELECT _source_row, Unit_Price_USD, _bad_price FROM judged"
    q["clean_discount"] = f"SELECT _source_row, Discount_Rate, _bad_discount FROM ({raw})"
    q["clean_dates"] = "SELECT _source_row, day AS Order_Date, _bad_date FROM judged"
    q["clean_category"] = """
SELECT _source_row, approved AS Category, Category <> approved AS _bad_category FROM sheet JOIN categories USING (Product)"""
    q["clean_final"] = "SELECT * FROM cleaned"
    q["cleaning_log"] = """
WITH c AS (
  SELECT CAST(sum(_copies - 1) AS BIGINT) AS dup, count(*) FILTER (_city_missing) AS city,
         count(*) FILTER (_city_unknown) AS city_u, count(*) FILTER (_payment_missing) AS pay,
         count(*) FILTER (_payment_unknown) AS pay_u, count(*) FILTER (_bad_quantity) AS qty,
         count(*) FILTER (NOT _bad_quantity AND _bad_price) AS price,
         count(*) FILTER (NOT _bad_quantity AND _bad_discount) AS disc,
         count(*) FILTER (checked AND _bad_date) AS dates, count(*) FILTER (checked AND day IS NULL) AS lost,
         count(*) FILTER (kept AND _bad_category) AS cat
  FROM judged)
SELECT 'Remove exact duplicates' AS Step, dup AS Rows_Affected, 'Removed completely identical rows' AS Decision FROM c
UNION ALL SELECT 'Handle missing City', city,
  'Recovered ' || (city - city_u) || ' from the same order; labeled ' || city_u || ' as Unknown' FROM c
UNION ALL SELECT 'Handle missing Payment_Method', pay,
  'Recovered ' || (pay - pay_u) || ' from the same order; labeled ' || pay_u || ' as Unknown' FROM c
UNION ALL SELECT 'Validate quantity', qty, 'Removed rows with non-numeric, zero, or negative quantity' FROM c
UNION ALL SELECT 'Repair unit prices', price, 'Replaced with median valid price for the same product' FROM c
UNION ALL SELECT 'Validate discount rates', disc, 'Removed rows with discount rates outside 0-1' FROM c
UNION ALL SELECT 'Validate order dates', dates,
  'Recovered ' || (dates - lost) || ' from the same order; removed ' || lost || ' unrecoverable rows' FROM c
UNION ALL SELECT 'Correct product categories', cat, 'Replaced with the approved category for each product' FROM c"""
    any_null = " OR ".join(f"{c} IS NULL" for c in t.SHEET_COLUMNS)
    every = ", ".join(t.SHEET_COLUMNS)
    broken = {
        "Exact duplicates remain": f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {every} FROM cleaned)) FROM cleaned)",
        "Line IDs are duplicated": "(SELECT count(*) - count(DISTINCT Order_Line_ID) FROM cleaned)",
        "Missing values remain": f"(SELECT count(*) FROM cleaned WHERE {any_null})",
        "Invalid quantities remain": "(SELECT count(*) FROM cleaned WHERE Quantity <= 0)",
        "Invalid prices remain": "(SELECT count(*) FROM cleaned WHERE Unit_Price_USD <= 0)",
        "Invalid discounts remain": "(SELECT count(*) FROM cleaned WHERE Discount_Rate < 0 OR Discount_Rate > 1)",
        "Invalid dates remain": "(SELECT count(*) FROM cleaned WHERE year(Order_Date) NOT BETWEEN 1995 AND 2000)",
        "Product/category mismatches remain": "(SELECT count(*) FROM cleaned JOIN categories USING (Product) WHERE Category <> approved)",
    }
    q["clean_postconditions"] = _union(f"SELECT '{rule}' AS rule, {n} AS violations" for rule, n in broken.items())

    q["kpi_lines"] = """
SELECT Order_Line_ID, g AS Gross_Sales_USD, d AS Discount_Amount_USD, n AS Net_Revenue_USD, year(Order_Date) AS Year,
       Month, monthname(Order_Date) AS Month_Name FROM sold_lines"""
    q["kpi_summary"] = _union(
        [
            _median_text("Total Gross Sales (USD)", "g"),
            _median_text("Total Discount (USD)", "d"),
            _median_text("Total Net Revenue (USD)", "n"),
            _median_text("Total Orders", "orders"),
            _median_text("Total Units Sold", "units"),
            _median_text("Average Order Value (USD)", t.rounded_quotient("n", "orders")),
            _median_text("Average Selling Price (USD)", t.rounded_quotient("n", "units")),
            _median_text("Effective Discount Rate (%)", t.rounded_quotient("d * 10000", "CAST(g * 100 AS HUGEINT)")),
            _winner("Top-Selling Product", "kpi_product", "Product", "Units_Sold DESC, Net_Revenue_USD DESC"),
            _winner("Highest-Revenue Product", "kpi_product", "Product", "Net_Revenue_USD DESC"),
            _winner("Highest-Revenue Category", "kpi_category", "Category", "Net_Revenue_USD DESC"),
            _winner("Highest-Revenue City", "kpi_city", "City", "Net_Revenue_USD DESC", "WHERE City <> 'Unknown'"),
            _winner("Best Revenue Month", "kpi_month", "Month", "Net_Revenue_USD DESC"),
            _winner("Most-Used Payment Method", "kpi_payment", "Payment_Method", "Orders DESC, Net_Revenue_USD DESC"),
        ]
    )
    q["kpi_reconcile"] = _union(
        f"SELECT '{name}' AS table_name, CAST(sum(Net_Revenue_USD) AS DECIMAL(18,2)) AS table_revenue, "
        "(SELECT n FROM sold_totals) AS total_revenue, "
        f"abs(sum(Net_Revenue_USD) - (SELECT n FROM sold_totals)) <= 0.01 AS reconciled FROM {table}"
        for name, table in (
            ("Product_Analysis", "kpi_product"),
            ("Category_Analysis", "kpi_category"),
            ("City_Analysis", "kpi_city"),
            ("Monthly_Sales", "kpi_month"),
            ("Payment_Analysis", "kpi_payment"),
        )
    )
    q["kpi_run_result"] = """
SELECT (SELECT count(*) FROM sheet) AS raw_rows, (SELECT count(*) FROM cleaned) AS clean_rows, orders AS unique_orders,
       units AS units_sold, g AS gross_sales, n AS net_revenue FROM sold_totals"""

    for kind in ("unique", "not_null", "accepted_values", "relationships"):
        q[f"test_{kind}"] = _model_tests(kind)
    bad_values = "{} WHERE quantity <= 0 OR unit_cost < 0 OR unit_price <= 0"
    q["check_item_values"] = _union(
        [_named_count("staged", bad_values.format("stg_order_items")), _named_count("accepted", bad_values.format("int_order_items"))]
    )
    orphan = """{} i LEFT JOIN int_orders o USING (order_id) LEFT JOIN int_customers c USING (customer_id)
LEFT JOIN int_products p USING (product_id)
WHERE o.order_id IS NULL OR c.customer_id IS NULL OR p.product_id IS NULL"""
    q["check_item_parents"] = _union(
        [_named_count("staged", orphan.format("stg_order_items")), _named_count("accepted", orphan.format("int_order_items"))]
    )
    early = """{0}_returns r JOIN {0}_order_items i USING (line_id) JOIN {0}_orders o USING (order_id)
WHERE return_date < CAST(order_timestamp AS DATE)"""
    q["check_return_dates"] = _union(
        [_named_count("staged", early.format("stg")), _named_count("accepted", early.format("int"))]
    )
    excess = "{0}_returns r JOIN {0}_order_items i USING (line_id) WHERE returned_quantity > quantity"
    q["check_return_quantities"] = _union(
        [_named_count("staged", excess.format("stg")), _named_count("accepted", excess.format("int"))]
    )
    q["check_identities"] = """
SELECT 'financial_identities' AS check_name,
  (SELECT count(*) FROM fact_sales WHERE gross_sales <> round(ordered_quantity * unit_price, 2)
     OR discount_amount <> round(gross_sales * discount_rate, 2) OR net_sales + discount_amount <> gross_sales
     OR cogs <> round(ordered_quantity * unit_cost, 2) OR gross_profit + cogs <> net_sales)
  + (SELECT count(*) FROM fact_returns
     WHERE returned_revenue <> round(returned_quantity * unit_price * (1 - discount_rate), 2)
        OR reversed_cogs <> round(returned_quantity * unit_cost, 2) OR profit_impact + reversed_cogs <> returned_revenue)
  AS violations"""
    q["check_layers"] = _union(
        f"SELECT *, source_count = accepted_count + rejected_count AS balanced FROM (SELECT '{table}' AS source_table, "
        f"(SELECT count(*) FROM src_{table}) AS source_count, (SELECT count(*) FROM int_{table}) AS accepted_count, "
        f"(SELECT count(DISTINCT source_row) FROM int_rejected_records WHERE source_table = '{table}') AS rejected_count)"
        for table in t.CONFORMED
    )
    q["check_marts"] = """
WITH s AS (SELECT count(*) AS n, count(DISTINCT order_id) AS orders, sum(net_sales) AS net, sum(gross_profit) AS profit FROM fact_sales),
b AS (SELECT count(*) AS n, sum(returned_revenue) AS back, sum(profit_impact) AS lost FROM fact_returns)
SELECT 'executive_grain_or_totals' AS check_name, CAST(count(*) AS BIGINT) AS violations FROM mart_executive, s, b
WHERE sales_line_count <> s.n OR order_count <> orders OR return_event_count <> b.n OR abs(net_sales - net) > 0.01
   OR abs(return_adjusted_revenue - (net - back)) > 0.01 OR abs(return_adjusted_profit - (profit - lost)) > 0.01
UNION ALL SELECT 'executive_row_count', CAST(count(*) <> 1 AS BIGINT) FROM mart_executive
UNION ALL SELECT 'customer_totals', CAST(sum(order_count) <> max(orders) OR abs(sum(net_sales) - max(net)) > 0.01
   OR abs(sum(return_adjusted_value) - (max(net) - max(back))) > 0.01 AS BIGINT) FROM mart_customer_360, s, b
UNION ALL SELECT 'cohort_population', CAST((SELECT count(*) FROM mart_cohort_base)
   <> (SELECT count(*) FROM order_totals WHERE completed) AS BIGINT)
UNION ALL SELECT 'cohort_measures', count(*) FROM mart_cohort_base c FULL JOIN (SELECT * FROM order_totals WHERE completed) e
   USING (order_id) WHERE c.customer_id IS DISTINCT FROM e.customer_id OR c.net_sales IS DISTINCT FROM e.net_sales
UNION ALL SELECT 'basket_measures', count(*) FROM mart_basket_base WHERE remaining_quantity <= 0
UNION ALL SELECT 'forecast_totals', CAST(sum(order_count) < max(orders) OR abs(sum(net_sales) - max(net)) > 0.01
   OR abs(sum(return_adjusted_revenue) - (max(net) - max(back))) > 0.01 AS BIGINT) FROM mart_forecasting_base, s, b"""

    q["profile_shape"] = "SELECT count(*) AS row_count, count(DISTINCT Order_ID) AS unique_keys, CAST(11 AS BIGINT) AS column_count FROM sheet"
    q["profile_missing"] = "SELECT * FROM ({}) WHERE missing > 0".format(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM sheet" for c in t.SHEET_COLUMNS
        )
    )
    q["profile_duplicates"] = f"""
SELECT {every}, _source_row FROM (SELECT *, count(*) OVER (PARTITION BY {every}) AS n FROM sheet) WHERE n > 1"""
    q["profile_value_counts"] = _union(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM sheet GROUP BY {c}" for c in ("City", "Quantity")
    )
    q["profile_numeric"] = _union(
        f"SELECT '{c}' AS column_name, count({c}) AS value_count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM sheet"
        for c in ("Unit_Price_USD", "Discount_Rate")
    )
    rules = {
        "Exact duplicate rows": f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {every} FROM sheet)) FROM sheet)",
        "Duplicate Order_Line_ID values": "(SELECT count(*) - count(DISTINCT Order_Line_ID) FROM sheet)",
        "Missing city values": "(SELECT count(*) FROM sheet WHERE City IS NULL)",
        "Missing payment methods": "(SELECT count(*) FROM sheet WHERE Payment_Method IS NULL)",
        "Non-standard city values": "(SELECT count(*) FROM sheet WHERE City NOT IN (SELECT upper(n_name[1]) || lower(n_name[2:]) FROM nation))",
        "Non-numeric quantities": "(SELECT count(*) FROM sheet WHERE try_cast(Quantity AS DOUBLE) IS NULL)",
        "Zero or negative quantities": "(SELECT count(*) FROM sheet WHERE try_cast(Quantity AS DOUBLE) <= 0)",
        "Zero or negative unit prices": "(SELECT count(*) FROM sheet WHERE Unit_Price_USD <= 0)",
        "Discount rates outside 0-1": "(SELECT count(*) FROM sheet WHERE Discount_Rate < 0 OR Discount_Rate > 1)",
        "Unparseable order dates": "(SELECT count(*) FROM sheet WHERE try_cast(Order_Date AS DATE) IS NULL)",
        "Dates outside scope": "(SELECT count(*) FROM sheet WHERE year(try_cast(Order_Date AS DATE)) NOT BETWEEN 1995 AND 2000)",
        "Product/category mismatches": "(SELECT count(*) FROM sheet JOIN categories USING (Product) WHERE Category <> approved)",
    }
    q["profile_quality_summary"] = _union(
        f"SELECT '{rule}' AS Quality_Check, {n} AS Issue_Count" for rule, n in rules.items()
    )

    q["signal_season"] = """
SELECT *, CAST(peak_revenue AS DOUBLE) / CAST(base_revenue AS DOUBLE) AS lift
FROM (SELECT CAST(sum(net_sales) FILTER (month_number >= 10) AS DECIMAL(18,2)) AS peak_revenue,
             CAST(sum(net_sales) FILTER (month_number BETWEEN 4 AND 6) AS DECIMAL(18,2)) AS base_revenue
      FROM fact_sales JOIN dim_date USING (date_key))"""
    q["signal_trend"] = "SELECT year(order_timestamp) AS order_year, count(*) AS order_count FROM int_orders GROUP BY 1"
    q["signal_promotion"] = """
WITH o AS (SELECT order_id, promotion_id IS NOT NULL AS p,
                  month(order_timestamp) * 100 + day(order_timestamp) BETWEEN 915 AND 1015 AS c FROM int_orders)
SELECT (SELECT count(*) FROM o WHERE p) AS promoted_orders, (SELECT count(*) FROM o WHERE c) AS control_orders,
       count(*) FILTER (p) AS promoted_lines, count(*) FILTER (c) AS control_lines,
       round(avg(CAST(discount_rate AS DOUBLE)) FILTER (p), 6) AS promoted_discount,
       round(avg(CAST(discount_rate AS DOUBLE)) FILTER (c), 6) AS control_discount
FROM int_order_items JOIN o USING (order_id)"""
    q["signal_channel"] = """
SELECT channel, count(*) AS order_count, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM int_orders) AS DOUBLE) AS share
FROM int_orders GROUP BY channel"""
    q["signal_affinity"] = """
SELECT with_source, count(*) AS order_count, count(*) FILTER (t) AS target_orders,
       CAST(count(*) FILTER (t) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS target_rate
FROM (SELECT bool_or(product_id IN ('P-1', 'P-2')) AS with_source, bool_or(product_id = 'P-3') AS t
      FROM int_order_items GROUP BY order_id) GROUP BY with_source"""
    q["signal_repeat"] = """
SELECT count(*) FILTER (n = 1) AS single_purchase_customers, count(*) FILTER (n > 1) AS repeat_customers,
       min(y) FILTER (n = 1) AS single_first_year, max(y) FILTER (n = 1) AS single_last_year
FROM (SELECT customer_id, count(*) AS n, min(year(order_timestamp)) AS y FROM int_orders GROUP BY customer_id)"""
    q["signal_returns"] = """
SELECT count(*) FILTER (returned_quantity < quantity) AS partial_returns,
       count(*) FILTER (returned_quantity = quantity) AS full_returns
FROM int_returns JOIN int_order_items USING (line_id)"""
    q["signal_cross_week"] = """
SELECT count(*) AS cross_week_returns
FROM fact_returns JOIN dim_date o ON o.date_key = order_date_key JOIN dim_date r ON r.date_key = return_date_key
WHERE date_trunc('week', o.full_date) <> date_trunc('week', r.full_date)"""
    q |= analyses.statements()
    broken = damage.damaged_tables(CTE)
    damaged = {f"damaged_{name}": with_tables(q[name], broken) for name in damage.QUERIES}
    return {name: with_tables(sql) for name, sql in q.items()} | damaged
