"""SQL definitions of the models, as common table expressions for the checking engine.

Each entry is one named query; it may use the input tables and the entries above it.
"""

LOAD = "load-0001"
TABLES = ("customers", "products", "orders", "order_items", "returns", "promotions", "calendar_events")
CONFORMED = ("customers", "products", "promotions", "orders", "order_items", "returns")

CTE: dict[str, str] = {}

# --- sources ------------------------------------------------------------------------------------

CTE["batch_dates"] = """
SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS start_date,
       CAST(last_day(CAST(max(o_orderdate) AS DATE) - INTERVAL 1 MONTH) AS DATE) AS end_date
FROM orders"""

CTE["li"] = """
SELECT *, row_number() OVER () - 1 AS rn,
       CAST(l_quantity AS BIGINT) AS q,
       CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS price_cents,
       l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
         || strftime(l_shipdate, '%Y%m%d') AS parts
FROM lineitem"""

CTE["src_customers"] = """
SELECT 'C-' || c_custkey AS customer_id,
       CAST(DATE '1995-01-01' - CAST(c_custkey % 731 AS INTEGER) AS DATE) AS signup_date,
       n_name AS home_city, c_mktsegment AS segment, rn AS _source_row
FROM (SELECT *, row_number() OVER () - 1 AS rn FROM customer) c JOIN nation ON n_nationkey = c_nationkey"""

CTE["src_products"] = """
SELECT 'P-' || p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS base_price,
       (CAST(round(p_retailprice * 100) AS BIGINT) * 70 // 100) / 100.0::DOUBLE AS base_cost,
       row_number() OVER () - 1 AS _source_row
FROM part"""

CTE["src_orders"] = """
SELECT 'O-' || o_orderkey AS order_id, 'C-' || o_custkey AS customer_id, o_orderdate AS order_timestamp,
       CASE o_orderstatus WHEN 'O' THEN 'Online' WHEN 'F' THEN 'Store' WHEN 'P' THEN 'Marketplace' END AS channel,
       CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'Credit Card'
            WHEN o_orderpriority[1] = '3' THEN 'Debit Card' ELSE 'Digital Wallet' END AS payment_method,
       CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) BETWEEN 1115 AND 1215
            THEN 'PROMO-' || year(o_orderdate) END AS promotion_id,
       row_number() OVER () - 1 AS _source_row
FROM orders"""

CTE["src_order_items"] = """
SELECT 'L-' || parts AS line_id, 'O-' || l_orderkey AS order_id, 'P-' || l_partkey AS product_id, q AS quantity,
       price_cents / 100.0::DOUBLE AS unit_price, (price_cents * 70 // 100) / 100.0::DOUBLE AS unit_cost,
       l_discount AS discount_rate, rn AS _source_row
FROM li"""

CTE["src_returns"] = """
SELECT 'R-' || parts AS return_id, 'L-' || parts AS line_id, CAST(l_shipdate AS DATE) AS return_date,
       CASE WHEN l_linestatus = 'F' THEN q ELSE greatest(q // 2, 1) END AS returned_quantity,
       CASE l_suppkey % 3 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Changed mind' ELSE 'Wrong item' END AS reason,
       rn AS _source_row
FROM li WHERE l_returnflag = 'R'"""

CTE["src_promotions"] = """
SELECT 'PROMO-' || y AS promotion_id, 'holiday' AS promotion_type, make_date(y, 11, 15) AS start_date,
       make_date(y, 12, 15) AS end_date, CAST(0.10 AS DOUBLE) AS discount_policy, row_number() OVER (ORDER BY y) - 1 AS _source_row
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)"""

CTE["src_calendar_events"] = """
SELECT d AS date, CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year' END AS holiday,
       CASE WHEN month(d) * 100 + day(d) BETWEEN 1115 AND 1215 THEN 'PROMO-' || year(d) END AS campaign,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring'
            WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS seasonal_event,
       date_diff('day', start_date, d) AS _source_row
FROM (SELECT start_date, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS d
      FROM batch_dates)"""

# --- staging ------------------------------------------------------------------------------------

_STAGED = {
    "customers": "customer_id, signup_date, home_city, segment",
    "products": "product_id, name AS product_name, category, CAST(base_price AS DECIMAL(18,2)) AS base_price, "
    "CAST(base_cost AS DECIMAL(18,2)) AS base_cost",
    "orders": "order_id, customer_id, order_timestamp, channel, payment_method, promotion_id",
    "order_items": "line_id, order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,2)) AS unit_price, "
    "CAST(unit_cost AS DECIMAL(18,2)) AS unit_cost, CAST(discount_rate AS DECIMAL(9,4)) AS discount_rate",
    "returns": "return_id, line_id, return_date, returned_quantity, reason",
    "promotions": "promotion_id, promotion_type, start_date, end_date, "
    "CAST(discount_policy AS DECIMAL(9,4)) AS discount_policy",
    "calendar_events": "date AS event_date, holiday, campaign, seasonal_event",
}
for _t, _columns in _STAGED.items():
    CTE[f"stg_{_t}"] = f"""
SELECT {_columns}, '{LOAD}' AS _load_id, '{_t}.csv' AS _source_file, CAST(_source_row AS BIGINT) AS _source_row
FROM src_{_t}"""

# --- contract findings --------------------------------------------------------------------------

NOT_NULL = {
    "customers": ("customer_id", "signup_date", "home_city", "segment"),
    "products": ("product_id", "name", "category", "base_price", "base_cost"),
    "orders": ("order_id", "customer_id", "order_timestamp", "channel", "payment_method"),
    "order_items": ("line_id", "order_id", "product_id", "quantity", "unit_price", "unit_cost", "discount_rate"),
    "returns": ("return_id", "line_id", "return_date", "returned_quantity", "reason"),
    "promotions": ("promotion_id", "promotion_type", "start_date", "end_date", "discount_policy"),
    "calendar_events": ("date", "seasonal_event"),
}
_IN_BATCH = "CAST({c} AS DATE) BETWEEN (SELECT start_date FROM batch_dates) AND (SELECT end_date FROM batch_dates)"
_BY_END = "{c} <= (SELECT end_date FROM batch_dates)"
VALUE_RULES = (
    ("customers", "signup_date_on_or_before_batch_end", "signup_date", _BY_END),
    ("customers", "segment_allowed", "segment", "{c} IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
    ("products", "base_price_positive", "base_price", "{c} > 0"),
    ("products", "base_cost_positive", "base_cost", "{c} > 0"),
    ("orders", "order_timestamp_in_range", "order_timestamp", _IN_BATCH),
    ("orders", "channel_allowed", "channel", "{c} IN ('Online', 'Store', 'Marketplace')"),
    ("orders", "payment_method_allowed", "payment_method", "{c} IN ('Credit Card', 'Debit Card', 'Digital Wallet')"),
    ("order_items", "quantity_positive", "quantity", "{c} > 0"),
    ("order_items", "unit_price_positive", "unit_price", "{c} > 0"),
    ("order_items", "unit_cost_positive", "unit_cost", "{c} > 0"),
    ("order_items", "discount_rate_between_zero_and_one", "discount_rate", "{c} BETWEEN 0 AND 1"),
    ("returns", "return_date_on_or_before_batch_end", "return_date", _BY_END),
    ("returns", "returned_quantity_positive", "returned_quantity", "{c} > 0"),
    ("returns", "return_reason_allowed", "reason", "{c} IN ('Damaged', 'Changed mind', 'Wrong item')"),
    ("promotions", "promotion_start_date_in_range", "start_date", _IN_BATCH),
    ("promotions", "promotion_end_date_in_range", "end_date", _IN_BATCH),
    ("promotions", "discount_policy_between_zero_and_one", "discount_policy", "{c} BETWEEN 0 AND 1"),
    ("calendar_events", "calendar_date_in_range", "date", _IN_BATCH),
    ("calendar_events", "season_allowed", "seasonal_event", "{c} IN ('Winter', 'Spring', 'Summer', 'Autumn')"),
)
PAIRS = (
    ("products", "base_cost_lte_price", "base_cost", "base_price"),
    ("order_items", "unit_cost_lte_unit_price", "unit_cost", "unit_price"),
    ("promotions", "promotion_start_lte_end", "start_date", "end_date"),
)
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "line_id",
    "returns": "return_id",
    "promotions": "promotion_id",
    "calendar_events": "date",
}
FOREIGN_KEYS = (
    ("orders", "customer_id_foreign_key", "customer_id", "customers"),
    ("orders", "promotion_id_foreign_key", "promotion_id", "promotions"),
    ("order_items", "order_id_foreign_key", "order_id", "orders"),
    ("order_items", "product_id_foreign_key", "product_id", "products"),
    ("returns", "line_id_foreign_key", "line_id", "order_items"),
)


def _finding(table: str, check: str, column: str, case: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS source_table, CAST(_source_row AS BIGINT) AS source_row, '{check}' AS check_name, "
        f"'{column}' AS column_name, {case} AS failure_case FROM {source}"
    )


def foreign_key_sql(table: str, check: str, column: str, parent: str, child_from: str, parent_from: str) -> str:
    source = (
        f"{child_from} AS c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_from} AS p WHERE p.{KEYS[parent]} = c.{column})"
    )
    return _finding(table, check, column, f"CAST({column} AS VARCHAR)", source)


def _unique(table: str, key: str) -> str:
    """Repeated NULLs are repeats too."""
    return f"(SELECT coalesce(max(n), 0) <= 1 FROM (SELECT count(*) AS n FROM {table} GROUP BY {key}))"


def complete(table: str, alias: str = "") -> str:
    """Rules on several columns judge rows without any NULL."""
    return " AND ".join(f"{alias}{c} IS NOT NULL" for c in NOT_NULL[table])


def return_quantity_sql(items: str) -> str:
    case = "'returned_quantity=' || returned_quantity || ', line_id=''' || r.line_id || ''''"
    source = (
        f"src_returns r LEFT JOIN {items} i ON i.line_id = r.line_id "
        f"WHERE {complete('returns', 'r.')} AND {_unique(items, 'line_id')} AND (i.quantity IS NULL OR r.returned_quantity > i.quantity)"
    )
    sql = _finding("returns", "returned_quantity_lte_ordered", "returned_quantity,line_id", case, source)
    return sql.replace("CAST(_source_row", "CAST(r._source_row")


def return_date_sql(items: str, orders: str) -> str:
    case = "'return_date=' || r.return_date || ', line_id=''' || r.line_id || ''''"
    source = (
        f"src_returns r LEFT JOIN {items} i ON i.line_id = r.line_id LEFT JOIN {orders} o ON o.order_id = i.order_id "
        f"WHERE {complete('returns', 'r.')} AND {_unique(items, 'line_id')} AND {_unique(orders, 'order_id')} "
        "AND (o.order_timestamp IS NULL OR r.return_date < CAST(o.order_timestamp AS DATE))"
    )
    sql = _finding("returns", "return_date_on_or_after_order", "return_date,line_id", case, source)
    return sql.replace("CAST(_source_row", "CAST(r._source_row")


def _all_findings() -> str:
    parts = []
    for t, columns in NOT_NULL.items():
        parts += [_finding(t, "not_nullable", c, "NULL", f"src_{t} WHERE {c} IS NULL") for c in columns]
    for t, check, c, ok in VALUE_RULES:
        parts.append(_finding(t, check, c, f"CAST({c} AS VARCHAR)", f"src_{t} WHERE NOT ({ok.format(c=c)})"))
    for t, check, low, high in PAIRS:
        case = f"'{low}=' || {low} || ', {high}=' || {high}"
        parts.append(_finding(t, check, f"{low},{high}", case, f"src_{t} WHERE {low} > {high} AND {complete(t)}"))
    for t, key in KEYS.items():
        repeated = f"SELECT {key} FROM src_{t} GROUP BY {key} HAVING count(*) > 1"
        parts.append(_finding(t, "field_uniqueness", key, f"CAST({key} AS VARCHAR)", f"src_{t} WHERE {key} IN ({repeated})"))
    for t, check, c, parent in FOREIGN_KEYS:
        parts.append(foreign_key_sql(t, check, c, parent, f"src_{t}", f"src_{parent}"))
    parts.append(return_quantity_sql("src_order_items"))
    parts.append(return_date_sql("src_order_items", "src_orders"))
    return "\nUNION ALL ".join(parts)


CTE["findings"] = _all_findings()
CTE["closed_orders"] = """
SELECT * REPLACE (CASE WHEN CAST(order_timestamp AS DATE) > (SELECT end_date FROM batch_dates) THEN 'late-' || order_id ELSE order_id END
                  AS order_id) FROM src_orders"""
CTE["closed_items"] = """
SELECT i.* REPLACE (CASE WHEN CAST(l_shipdate AS DATE) > (SELECT end_date FROM batch_dates) THEN 'late-' || line_id ELSE line_id END
                    AS line_id) FROM src_order_items i JOIN li ON li.rn = i._source_row"""
CTE["finding_counts"] = """
SELECT source_table, count(DISTINCT source_row) AS bad, count(*) AS failure_count FROM findings GROUP BY source_table"""
CTE["table_sizes"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS source_table, count(*) AS total_rows FROM src_{t}" for t in TABLES
)

# --- silver -------------------------------------------------------------------------------------


def _passed(table: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM findings f WHERE f.source_table = '{table}' AND f.source_row = s._source_row)"


_PARENT_TESTS = {
    "orders": " AND customer_id IN (SELECT customer_id FROM int_customers)"
    " AND (promotion_id IS NULL OR promotion_id IN (SELECT promotion_id FROM int_promotions))",
    "order_items": " AND order_id IN (SELECT order_id FROM int_orders)"
    " AND product_id IN (SELECT product_id FROM int_products)",
    "returns": " AND line_id IN (SELECT line_id FROM int_order_items)",
}
for _t in CONFORMED:
    CTE[f"int_{_t}"] = f"SELECT s.* FROM stg_{_t} s WHERE {_passed(_t)}{_PARENT_TESTS.get(_t, '')}"

CTE["int_promotion_assignments"] = """
SELECT order_id, promotion_id, _load_id, _source_file, _source_row
FROM int_orders WHERE promotion_id IN (SELECT promotion_id FROM int_promotions)"""


def _cascade(table: str, key: str, parent: str, rule: str, reason: str) -> str:
    return (
        f"SELECT _load_id, '{table}', _source_row, _source_file, '{rule}', '{reason} parent was rejected during conformance' "
        f"FROM stg_{table} s WHERE {_passed(table)} AND {key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM int_{parent} p WHERE p.{key} = s.{key})"
    )


CTE["int_rejected_records"] = "\nUNION ALL ".join(
    [
        f"SELECT '{LOAD}' AS load_id, source_table, source_row, source_table || '.csv' AS source_file, "
        "check_name AS rule_code, coalesce(failure_case, column_name || ' failed ' || check_name) AS reason "
        "FROM findings WHERE source_table <> 'calendar_events'",
        _cascade("orders", "customer_id", "customers", "customer_not_accepted", "customer"),
        _cascade("orders", "promotion_id", "promotions", "promotion_not_accepted", "promotion"),
        _cascade("order_items", "order_id", "orders", "order_not_accepted", "order"),
        _cascade("order_items", "product_id", "products", "product_not_accepted", "product"),
        _cascade("returns", "line_id", "order_items", "order_item_not_accepted", "order-item"),
    ]
)

# --- gold ---------------------------------------------------------------------------------------


def day_number(expression: str) -> str:
    return f"CAST(strftime({expression}, '%Y%m%d') AS BIGINT)"


CTE["dim_date"] = f"""
SELECT {day_number('d')} AS date_key, d AS full_date, year(d) AS year_number, quarter(d) AS quarter_number,
       month(d) AS month_number, monthname(d) AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
       dayname(d) AS day_name, c.holiday, c.campaign, c.seasonal_event
FROM (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM stg_calendar_events) LEFT JOIN stg_calendar_events c ON c.event_date = d"""
CTE["dim_customer"] = "SELECT customer_id, signup_date, home_city, segment FROM int_customers"
CTE["dim_product"] = "SELECT product_id, product_name, category, base_price, base_cost FROM int_products"
CTE["dim_channel"] = "SELECT channel AS channel_key FROM int_orders GROUP BY ALL"
CTE["dim_geography"] = "SELECT home_city AS geography_key FROM int_customers GROUP BY ALL"
CTE["dim_promotion"] = "SELECT promotion_id, promotion_type, start_date, end_date, discount_policy FROM int_promotions"
CTE["dim_payment_method"] = "SELECT payment_method AS payment_method_key FROM int_orders GROUP BY ALL"
CTE["order_facts"] = f"""
SELECT o.order_id, o.customer_id, {day_number('o.order_timestamp')} AS order_day, o.channel, c.home_city,
       o.promotion_id, o.payment_method
FROM int_orders o JOIN int_customers c USING (customer_id)"""
CTE["fact_sales"] = """
WITH priced AS (
  SELECT i.*, CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS g,
         CAST(round(quantity * unit_cost, 2) AS DECIMAL(18,2)) AS k
  FROM int_order_items i),
reduced AS (SELECT *, CAST(round(g * discount_rate, 2) AS DECIMAL(18,2)) AS d FROM priced)
SELECT line_id, o.order_id, o.order_day AS date_key, o.customer_id, product_id, o.channel AS channel_key,
       o.home_city AS geography_key, o.promotion_id, o.payment_method AS payment_method_key,
       quantity AS ordered_quantity, unit_price, unit_cost, discount_rate, g AS gross_sales, d AS discount_amount,
       CAST(g - d AS DECIMAL(18,2)) AS net_sales, k AS cogs, CAST(g - d - k AS DECIMAL(18,2)) AS gross_profit
FROM reduced JOIN order_facts o USING (order_id)"""
CTE["fact_returns"] = f"""
WITH valued AS (
  SELECT r.return_id, r.line_id, i.order_id, {day_number('r.return_date')} AS return_date_key, i.product_id,
         r.returned_quantity, r.reason AS return_reason, i.unit_price, i.unit_cost, i.discount_rate,
         CAST(round(r.returned_quantity * i.unit_price * (1 - i.discount_rate), 2) AS DECIMAL(18,2)) AS returned_revenue,
         CAST(round(r.returned_quantity * i.unit_cost, 2) AS DECIMAL(18,2)) AS reversed_cogs
  FROM int_returns r JOIN int_order_items i USING (line_id))
SELECT return_id, line_id, o.order_id, return_date_key, o.order_day AS order_date_key, o.customer_id, product_id,
       o.channel AS channel_key, o.home_city AS geography_key, o.promotion_id, o.payment_method AS payment_method_key,
       returned_quantity, return_reason, unit_price, unit_cost, discount_rate, returned_revenue, reversed_cogs,
       CAST(returned_revenue - reversed_cogs AS DECIMAL(18,2)) AS profit_impact
FROM valued JOIN order_facts o USING (order_id)"""

# --- marts --------------------------------------------------------------------------------------

_SOLD = ("gross_sales", "discount_amount", "net_sales", "cogs", "gross_profit")
_BACK = ("returned_revenue", "reversed_cogs", "profit_impact")


def money_sum(column: str) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS DECIMAL(18,2)) AS {column}"


def unit_sum(column: str) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS BIGINT) AS {column}"


def _list(*items: str) -> str:
    return ", ".join(items)


CTE["mart_executive"] = f"""
SELECT s.*, r.*, CAST(net_sales - returned_revenue AS DECIMAL(18,2)) AS return_adjusted_revenue,
       CAST(gross_profit - profit_impact AS DECIMAL(18,2)) AS return_adjusted_profit
FROM (SELECT count(*) AS sales_line_count, count(DISTINCT order_id) AS order_count,
             count(DISTINCT customer_id) AS customer_count,
             CAST(sum(ordered_quantity) AS BIGINT) AS ordered_quantity,
             {_list(*[f'CAST(sum({m}) AS DECIMAL(18,2)) AS {m}' for m in _SOLD])} FROM fact_sales) s,
     (SELECT count(*) AS return_event_count, {unit_sum('returned_quantity')}, {_list(*[money_sum(m) for m in _BACK])}
      FROM fact_returns) r"""
CTE["order_sums"] = f"""
SELECT o.*, b.n_back, b.returned_quantity, {_list(*[f'b.{m}' for m in _BACK])}
FROM (SELECT order_id, customer_id, full_date AS order_date, {unit_sum('ordered_quantity')},
             {_list(*[money_sum(m) for m in _SOLD])}
      FROM fact_sales JOIN dim_date USING (date_key) GROUP BY ALL) o
LEFT JOIN (SELECT order_id, count(*) AS n_back, {unit_sum('returned_quantity')}, {_list(*[money_sum(m) for m in _BACK])}
           FROM fact_returns GROUP BY order_id) b USING (order_id)"""
CTE["order_totals"] = f"""
SELECT * REPLACE (coalesce(returned_quantity, 0) AS returned_quantity,
                  {_list(*[f'CAST(coalesce({m}, 0) AS DECIMAL(18,2)) AS {m}' for m in _BACK])}),
       ordered_quantity > coalesce(returned_quantity, 0) AS completed
FROM order_sums"""
_LIFE = ("gross_sales", "discount_amount", "net_sales", "returned_revenue", "cogs", "reversed_cogs", "gross_profit", "profit_impact")
CTE["mart_customer_360"] = f"""
SELECT *, CAST(net_sales - returned_revenue AS DECIMAL(18,2)) AS return_adjusted_value,
       CAST(gross_profit - profit_impact AS DECIMAL(18,2)) AS return_adjusted_profit
FROM (SELECT c.customer_id, any_value(c.signup_date) AS signup_date, any_value(c.home_city) AS home_city,
             any_value(c.segment) AS segment, min(CASE WHEN completed THEN order_date END) AS first_purchase_date,
             max(CASE WHEN completed THEN order_date END) AS last_purchase_date, count(t.order_id) AS order_count,
             count(CASE WHEN completed THEN 1 END) AS completed_order_count, {unit_sum('ordered_quantity')},
             {unit_sum('returned_quantity')}, {_list(*[money_sum(m) for m in _LIFE])}
      FROM dim_customer c LEFT JOIN order_totals t ON t.customer_id = c.customer_id GROUP BY c.customer_id)"""
CTE["mart_cohort_base"] = """
SELECT order_id, customer_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
       CAST(date_trunc('month', first_day) AS DATE) AS acquisition_cohort_month,
       date_diff('month', first_day, order_date) AS months_since_acquisition, ordered_quantity, returned_quantity,
       ordered_quantity - returned_quantity AS retained_quantity, net_sales, returned_revenue,
       CAST(net_sales - returned_revenue AS DECIMAL(18,2)) AS return_adjusted_value
FROM (SELECT *, min(order_date) OVER (PARTITION BY customer_id) AS first_day FROM order_totals WHERE completed)"""
CTE["mart_basket_base"] = f"""
WITH b AS (SELECT order_id, product_id, {unit_sum('returned_quantity')}, {money_sum('returned_revenue')}
           FROM fact_returns GROUP BY ALL),
s AS (SELECT order_id, customer_id, full_date AS order_date, product_id, {unit_sum('ordered_quantity')}, {money_sum('net_sales')}
      FROM fact_sales JOIN dim_date USING (date_key) GROUP BY ALL)
SELECT order_id, customer_id, order_date, product_id, product_name, category, ordered_quantity,
       coalesce(returned_quantity, 0) AS returned_quantity,
       ordered_quantity - coalesce(returned_quantity, 0) AS remaining_quantity, net_sales,
       CAST(coalesce(returned_revenue, 0) AS DECIMAL(18,2)) AS returned_revenue,
       CAST(net_sales - coalesce(returned_revenue, 0) AS DECIMAL(18,2)) AS return_adjusted_value
FROM s LEFT JOIN b USING (order_id, product_id) JOIN dim_product USING (product_id)
WHERE ordered_quantity > coalesce(returned_quantity, 0)"""


def _share(channel: str) -> str:
    name = channel.lower() + "_unit_share"
    return (
        f"coalesce(CAST(sum(ordered_quantity) FILTER (channel_key = '{channel}') AS DOUBLE) "
        f"/ CAST(sum(ordered_quantity) AS DOUBLE), 0.0) AS {name}"
    )


_ZEROED = ", ".join(
    [f"CAST(coalesce(s.{m}, 0) AS DECIMAL(18,2)) AS {m}" for m in _SOLD]
    + [f"CAST(coalesce(b.{m}, 0) AS DECIMAL(18,2)) AS {m}" for m in _BACK]
)
CTE["mart_forecasting_base"] = f"""
WITH grid AS (
  SELECT w.*, category
  FROM (SELECT CAST(date_trunc('week', full_date) AS DATE) AS week_start, count(holiday) AS holiday_days,
               count(campaign) AS campaign_days FROM dim_date GROUP BY 1) w,
       (SELECT DISTINCT category FROM dim_product)),
s AS (
  SELECT CAST(date_trunc('week', full_date) AS DATE) AS week_start, category, count(DISTINCT order_id) AS order_count,
         {unit_sum('ordered_quantity')}, {_list(*[money_sum(m) for m in _SOLD])},
         CAST(sum(gross_sales) AS DOUBLE) / CAST(sum(ordered_quantity) AS DOUBLE) AS average_unit_price,
         CAST(sum(discount_amount) AS DOUBLE) / CAST(sum(gross_sales) AS DOUBLE) AS effective_discount_rate,
         count(DISTINCT CASE WHEN promotion_id IS NOT NULL THEN order_id END) AS promoted_order_count,
         {_list(_share('Online'), _share('Store'), _share('Marketplace'))}
  FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_id) GROUP BY 1, 2),
b AS (
  SELECT CAST(date_trunc('week', full_date) AS DATE) AS week_start, category, {unit_sum('returned_quantity')},
         {_list(*[money_sum(m) for m in _BACK])}
  FROM fact_returns JOIN dim_date ON date_key = order_date_key JOIN dim_product USING (product_id) GROUP BY 1, 2)
SELECT *, CAST(net_sales - returned_revenue AS DECIMAL(18,2)) AS return_adjusted_revenue,
       CAST(gross_profit - profit_impact AS DECIMAL(18,2)) AS return_adjusted_profit
FROM (SELECT g.week_start, g.category, g.holiday_days, g.campaign_days, coalesce(s.order_count, 0) AS order_count,
             coalesce(s.ordered_quantity, 0) AS ordered_quantity, coalesce(b.returned_quantity, 0) AS returned_quantity,
             {_ZEROED}, s.average_unit_price, s.effective_discount_rate,
             coalesce(s.promoted_order_count, 0) AS promoted_order_count,
             coalesce(s.online_unit_share, 0.0) AS online_unit_share,
             coalesce(s.store_unit_share, 0.0) AS store_unit_share,
             coalesce(s.marketplace_unit_share, 0.0) AS marketplace_unit_share
      FROM grid g LEFT JOIN s USING (week_start, category) LEFT JOIN b USING (week_start, category))"""

# --- flat sheet ---------------------------------------------------------------------------------

SHEET_COLUMNS = (
    "Order_Line_ID", "Order_ID", "Order_Date", "Customer_ID", "Product", "Category", "City", "Quantity",
    "Unit_Price_USD", "Discount_Rate", "Payment_Method",
)
_ALL = ", ".join(SHEET_COLUMNS)

CTE["categories"] = """
SELECT p_brand AS Product, 'Cat-' || any_value(CAST(p_brand[7:] AS INTEGER) % 5) AS approved FROM part GROUP BY p_brand"""
CTE["sheet_lines"] = """
SELECT li.*, o_custkey, o_orderdate, o_orderpriority[1] AS urgency, p_brand, CAST(p_brand[7:] AS INTEGER) AS brand,
       upper(n_name[1]) || lower(n_name[2:]) AS city, (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 1000 AS m
FROM li JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey"""
CTE["sheet_once"] = """
SELECT 'L-' || parts AS Order_Line_ID, 'O-' || l_orderkey AS Order_ID,
       CASE WHEN m BETWEEN 48 AND 50 THEN 'not-a-date' WHEN m BETWEEN 51 AND 52 THEN '2025-13-40'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Order_Date,
       'C-' || o_custkey AS Customer_ID, p_brand AS Product,
       'Cat-' || (CASE WHEN m BETWEEN 53 AND 57 THEN brand + 1 ELSE brand END) % 5 AS Category,
       CASE WHEN m BETWEEN 0 AND 7 THEN NULL WHEN m BETWEEN 8 AND 15 THEN '  ' || city || ' '
            WHEN m BETWEEN 16 AND 19 THEN upper(city) WHEN m BETWEEN 20 AND 23 THEN lower(city) ELSE city END AS City,
       CASE WHEN m IN (32, 33) THEN '0' WHEN m IN (34, 35) THEN '-1' WHEN m IN (36, 37) THEN 'three'
            ELSE CAST(q AS VARCHAR) END AS Quantity,
       CAST(CASE WHEN m BETWEEN 38 AND 40 THEN 0 WHEN m BETWEEN 41 AND 42 THEN -25 ELSE price_cents / 100.0::DOUBLE END AS DOUBLE)
         AS Unit_Price_USD,
       CAST(CASE WHEN m BETWEEN 43 AND 45 THEN 1.2 WHEN m BETWEEN 46 AND 47 THEN -0.1 ELSE l_discount END AS DOUBLE)
         AS Discount_Rate,
       CASE WHEN m BETWEEN 24 AND 31 THEN NULL WHEN urgency = '1' THEN 'Credit Card' WHEN urgency = '2' THEN 'Debit Card'
            WHEN urgency = '3' THEN 'PayPal' ELSE 'Bank Transfer' END AS Payment_Method,
       rn * 2 AS _source_row, m
FROM sheet_lines"""
CTE["sheet"] = f"""
SELECT {_ALL}, _source_row FROM sheet_once
UNION ALL SELECT {_ALL}, _source_row + 1 FROM sheet_once WHERE m BETWEEN 60 AND 67"""
CTE["sheet_dedup"] = f"""
SELECT {_ALL}, min(_source_row) AS _source_row, count(*) AS _copies FROM sheet GROUP BY {_ALL}"""


def parsed_sql(source: str) -> str:
    return f"""
SELECT s.* REPLACE (
         trim(s.Product) AS Product, trim(s.Category) AS Category,
         upper(trim(s.City)[1]) || lower(trim(s.City)[2:]) AS City,
         CASE lower(trim(s.Payment_Method)) WHEN 'credit card' THEN 'Credit Card' WHEN 'debit card' THEN 'Debit Card'
              WHEN 'paypal' THEN 'PayPal' WHEN 'bank transfer' THEN 'Bank Transfer' END AS Payment_Method,
         CASE WHEN try_cast(s.Quantity AS DOUBLE) > 0 THEN CAST(try_cast(s.Quantity AS DOUBLE) AS BIGINT) END AS Quantity,
         CAST(s.Unit_Price_USD AS DECIMAL(24,12)) AS Unit_Price_USD),
       coalesce(try_cast(s.Quantity AS DOUBLE) <= 0, true) AS _bad_quantity,
       coalesce(s.Unit_Price_USD <= 0, false) AS _bad_price,
       NOT coalesce(s.Discount_Rate BETWEEN 0 AND 1, false) AS _bad_discount,
       NOT coalesce(year(try_cast(s.Order_Date AS DATE)) BETWEEN 1995 AND 2000, false) AS _bad_date,
       CASE WHEN year(try_cast(s.Order_Date AS DATE)) BETWEEN 1995 AND 2000 THEN try_cast(s.Order_Date AS DATE) END AS day
FROM {source} s"""


CTE["parsed"] = parsed_sql("sheet_dedup")
CTE["medians"] = """
SELECT Product, CAST(CAST(median(CAST(round(Unit_Price_USD * 100) AS DOUBLE)) * 100 AS BIGINT) / 10000.0 AS DECIMAL(24,12)) AS median
FROM parsed WHERE NOT _bad_quantity AND NOT _bad_price GROUP BY Product"""


def _near(column: str) -> str:
    w = "PARTITION BY Order_ID ORDER BY _source_row"
    return (
        f"coalesce(last_value({column} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({column} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


CTE["filled"] = f"""
SELECT * REPLACE ({_near('City')} AS City, {_near('Payment_Method')} AS Payment_Method, {_near('day')} AS day),
       City IS NULL AS _city_missing, Payment_Method IS NULL AS _payment_missing
FROM (SELECT * REPLACE (CASE WHEN NOT _bad_quantity AND NOT _bad_discount THEN day END AS day) FROM parsed)"""
CTE["judged"] = """
SELECT f.* EXCLUDE (Category, Unit_Price_USD, City, Payment_Method, Order_Date), c.approved AS Category,
       CASE WHEN _bad_price THEN m.median ELSE f.Unit_Price_USD END AS Unit_Price_USD,
       coalesce(City, 'Unknown') AS City, coalesce(Payment_Method, 'Unknown') AS Payment_Method,
       City IS NULL AS _city_unknown, Payment_Method IS NULL AS _payment_unknown,
       coalesce(f.Category <> c.approved, false) AS _bad_category,
       NOT _bad_quantity AND NOT _bad_discount AS checked,
       NOT _bad_quantity AND NOT _bad_discount AND day IS NOT NULL AS kept
FROM filled f LEFT JOIN categories c ON c.Product = f.Product LEFT JOIN medians m ON m.Product = f.Product"""
CTE["cleaned"] = f"""
SELECT {_ALL.replace('Order_Date', 'day AS Order_Date')}, _source_row FROM judged WHERE kept"""
CTE["sold_lines"] = """
SELECT *, CAST(g - d AS DECIMAL(18,2)) AS n
FROM (SELECT *, CAST(round(CAST(g AS DECIMAL(20,2)) * CAST(Discount_Rate AS DECIMAL(14,12)), 2) AS DECIMAL(18,2)) AS d
      FROM (SELECT *, CAST(round(CAST(Quantity AS DECIMAL(12,0)) * Unit_Price_USD, 2) AS DECIMAL(18,2)) AS g,
                   strftime(Order_Date, '%Y-%m') AS Month FROM cleaned))"""
CTE["sold_totals"] = """
SELECT CAST(sum(Quantity) AS BIGINT) AS units, count(DISTINCT Order_ID) AS orders, CAST(sum(g) AS DECIMAL(18,2)) AS g,
       CAST(sum(d) AS DECIMAL(18,2)) AS d, CAST(sum(n) AS DECIMAL(18,2)) AS n
FROM sold_lines"""


def rounded_quotient(numerator: str, denominator: str) -> str:
    """numerator / denominator in hundredths, rounded half up in whole numbers."""
    return (
        f"CAST((2 * CAST(({numerator}) * 100 AS HUGEINT) + ({denominator})) // (2 * ({denominator})) / 100.0 AS DECIMAL(18,2))"
    )


def grouped_sql(keys: str) -> str:
    share = rounded_quotient("n * 10000", "(SELECT CAST(n * 100 AS HUGEINT) FROM sold_totals)")
    return f"""
SELECT {keys}, units AS Units_Sold, orders AS Orders, g AS Gross_Sales_USD, d AS Discount_Amount_USD,
       n AS Net_Revenue_USD, {rounded_quotient('n', 'orders')} AS Average_Order_Value_USD, {share} AS Revenue_Share_Pct
FROM (SELECT {keys}, CAST(sum(Quantity) AS BIGINT) AS units, count(DISTINCT Order_ID) AS orders,
             CAST(sum(g) AS DECIMAL(18,2)) AS g, CAST(sum(d) AS DECIMAL(18,2)) AS d, CAST(sum(n) AS DECIMAL(18,2)) AS n
      FROM sold_lines GROUP BY {keys})"""


GROUPINGS = {
    "kpi_product": "Product, Category",
    "kpi_category": "Category",
    "kpi_city": "City",
    "kpi_month": "Month",
    "kpi_payment": "Payment_Method",
}
for _name, _keys in GROUPINGS.items():
    CTE[_name] = grouped_sql(_keys)
