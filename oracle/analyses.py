"""SQL of the analyses on the marts; definitions in ``TABLES`` join those of ``oracle.tables``."""

from __future__ import annotations


def _edge(value: str, k: int, parts: int, table: str, where: str = "TRUE") -> str:
    """The value at rank ceil(k * n / parts)."""
    return (
        f"(SELECT min(v) FROM (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) AS r, count(*) OVER () AS n FROM {table} "
        f"WHERE {where}) WHERE r >= (n * {k} + {parts} - 1) // {parts})"
    )


def _part(value: str, edge_of: str, parts: int) -> str:
    return "1 + " + " + ".join(f"CAST({value} > {edge_of.format(k=k)} AS INTEGER)" for k in range(1, parts))


TABLES: dict[str, str] = {}

TABLES["rfm_base"] = """
SELECT customer_id, last_purchase_date, completed_order_count AS frequency_orders, return_adjusted_value AS monetary_value,
       CASE WHEN completed_order_count > 0 AND last_purchase_date <= day THEN date_diff('day', last_purchase_date, day) END AS recency_days
FROM mart_customer_360, (SELECT CAST(end_date + INTERVAL 1 DAY AS DATE) AS day FROM batch_dates)"""
TABLES["rfm_edges"] = "SELECT " + ", ".join(
    f"{_edge(column, k, 5, 'rfm_base', 'recency_days IS NOT NULL')} AS {name}{k}"
    for name, column in (("r", "recency_days"), ("f", "frequency_orders"), ("m", "monetary_value"))
    for k in range(1, 5)
)
TABLES["rfm_scores"] = f"""
SELECT customer_id, last_purchase_date, recency_days, frequency_orders, monetary_value,
       CASE WHEN recency_days IS NOT NULL THEN 6 - ({_part('recency_days', 'r{k}', 5)}) END AS r_score,
       CASE WHEN recency_days IS NOT NULL THEN {_part('frequency_orders', 'f{k}', 5)} END AS f_score,
       CASE WHEN recency_days IS NOT NULL THEN {_part('monetary_value', 'm{k}', 5)} END AS m_score
FROM rfm_base, rfm_edges"""

TABLES["cutoffs"] = """
SELECT cutoff FROM (
  SELECT CAST(unnest(generate_series(date_trunc('year', start_date), CAST(end_date AS TIMESTAMP) + INTERVAL 1 YEAR, INTERVAL 3 MONTH)) AS DATE) - 1 AS cutoff,
         start_date, end_date FROM batch_dates)
WHERE cutoff BETWEEN start_date + 365 AND end_date"""
TABLES["return_days"] = """
SELECT *, returned_upto >= ordered_quantity AND returned_upto - units < ordered_quantity AS ends
FROM (SELECT order_id, o.customer_id, full_date AS day, o.ordered_quantity, sum(r.returned_quantity) AS units, sum(r.returned_revenue) AS revenue,
             sum(sum(r.returned_quantity)) OVER (PARTITION BY order_id ORDER BY full_date) AS returned_upto
      FROM fact_returns r JOIN dim_date ON date_key = return_date_key JOIN order_totals o USING (order_id)
      GROUP BY order_id, o.customer_id, full_date, o.ordered_quantity)"""
TABLES["customer_snapshots"] = """
WITH placed AS (
  SELECT customer_id, cutoff, count(*) AS order_count, sum(ordered_quantity) AS units, sum(net_sales) AS net,
         min(order_date) AS first_order, max(order_date) AS last_order
  FROM order_totals, cutoffs WHERE order_date <= cutoff GROUP BY ALL),
taken AS (
  SELECT customer_id, cutoff, count(*) FILTER (ends) AS ended, sum(units) AS units, sum(revenue) AS revenue
  FROM return_days, cutoffs WHERE day <= cutoff GROUP BY ALL),
later AS (
  SELECT DISTINCT customer_id, cutoff FROM order_totals, cutoffs WHERE completed AND order_date > cutoff AND order_date <= cutoff + 90)
SELECT p.customer_id, p.cutoff, order_count, order_count - coalesce(ended, 0) AS completed_order_count,
       CAST(p.units - coalesce(t.units, 0) AS BIGINT) AS net_units,
       CAST(net - coalesce(revenue, 0) AS DECIMAL(18,2)) AS net_value, date_diff('day', last_order, p.cutoff) AS recency_days,
       date_diff('day', first_order, p.cutoff) AS tenure_days,
       CASE WHEN p.cutoff + 90 <= end_date THEN CASE WHEN l.customer_id IS NULL THEN 1 ELSE 0 END END AS churned
FROM placed p LEFT JOIN taken t ON t.customer_id = p.customer_id AND t.cutoff = p.cutoff
LEFT JOIN later l ON l.customer_id = p.customer_id AND l.cutoff = p.cutoff, batch_dates"""

TABLES["weekly"] = """
SELECT *, date_diff('day', min(week_start) OVER (), week_start) // 7 AS period, ordered_quantity AS y FROM mart_forecasting_base"""
TABLES["folds"] = """
SELECT fold, 104 + 4 * fold AS train_weeks, first
FROM (SELECT unnest(range(0, 1 + CAST(floor((max(period) + 1 - 104 - 4) / 4) AS BIGINT))) AS fold, min(week_start) AS first FROM weekly)"""
TABLES["forecasts"] = """
WITH tested AS (
  SELECT fold, category, week_start, period, y, period - train_weeks + 1 AS horizon, train_weeks - 1 AS origin
  FROM weekly JOIN folds ON period BETWEEN train_weeks AND train_weeks + 3)
SELECT fold, t.category, t.week_start, horizon, 'last_value' AS model, t.y AS actual, p.y AS forecast
FROM tested t JOIN weekly p ON p.category = t.category AND p.period = t.origin
UNION ALL
SELECT fold, t.category, t.week_start, horizon, 'seasonal_naive', t.y, p.y
FROM tested t JOIN weekly p ON p.category = t.category AND p.period = t.period - 52"""

TABLES["cohort_counts"] = """
SELECT acquisition_cohort_month AS cohort_month, months_since_acquisition AS age, count(DISTINCT customer_id) AS active
FROM mart_cohort_base GROUP BY ALL"""
TABLES["cohort_long"] = """
WITH last AS (SELECT max(order_month) AS m FROM mart_cohort_base),
grid AS (SELECT cohort_month, active AS size, unnest(range(0, date_diff('month', cohort_month, m) + 1)) AS age_months
         FROM cohort_counts, last WHERE age = 0)
SELECT g.cohort_month, age_months, size AS cohort_size, coalesce(active, 0) AS active_customers,
       CAST(coalesce(active, 0) AS DOUBLE) / CAST(size AS DOUBLE) AS retention
FROM grid g LEFT JOIN cohort_counts c ON c.cohort_month = g.cohort_month AND c.age = age_months"""

TABLES["first_test"] = "SELECT end_date - 730 AS day FROM batch_dates"
TABLES["snapshots_train"] = "SELECT s.* FROM customer_snapshots s, first_test WHERE churned IS NOT NULL AND cutoff <= day - 91"
TABLES["snapshots_test"] = "SELECT s.* FROM customer_snapshots s, first_test WHERE churned IS NOT NULL AND cutoff >= day"
TABLES["recency_edges"] = "SELECT " + ", ".join(f"{_edge('recency_days', k, 5, 'snapshots_train')} AS e{k}" for k in range(1, 5))
TABLES["recency_scored"] = f"""
WITH rates AS (
  SELECT {_part('recency_days', 'e{k}', 5)} AS part, CAST(sum(churned) AS DOUBLE) / count(*) AS rate FROM snapshots_train, recency_edges GROUP BY 1),
whole AS (SELECT CAST(sum(churned) AS DOUBLE) / count(*) AS rate FROM snapshots_train)
SELECT t.*, whole.rate AS majority, coalesce(rates.rate, whole.rate) AS probability
FROM (SELECT t.*, {_part('recency_days', 'e{k}', 5)} AS part FROM snapshots_test t, recency_edges) t LEFT JOIN rates USING (part), whole"""

#: Read by several parts of a statement.
SHARED = {"rfm_base", "customer_snapshots", "weekly", "cohort_counts", "snapshots_train", "snapshots_test", "recency_scored", "mart_basket_base"}

_BRIER = """count(*) AS n, round(avg(CAST(churned AS DOUBLE)), 9) AS churn_rate, round(avg({p}), 9) AS mean_probability,
       round(avg(({p} - churned) * ({p} - churned)), 9) AS brier"""


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["mart_basket_pairs"] = """
WITH n AS (SELECT count(DISTINCT order_id) AS n FROM mart_basket_base),
items AS (SELECT product_id, count(DISTINCT order_id) AS c FROM mart_basket_base GROUP BY product_id),
pairs AS (
  SELECT a.product_id AS x, b.product_id AS y, count(*) AS c
  FROM mart_basket_base a JOIN mart_basket_base b ON a.order_id = b.order_id AND a.product_id <> b.product_id
  GROUP BY ALL)
SELECT x AS antecedent_id, y AS consequent_id, a.c AS antecedent_count, b.c AS consequent_count, p.c AS basket_count,
       CAST(p.c AS DOUBLE) / CAST(n AS DOUBLE) AS support, CAST(p.c AS DOUBLE) / CAST(a.c AS DOUBLE) AS confidence,
       CAST(p.c AS DOUBLE) * CAST(n AS DOUBLE) / (CAST(a.c AS DOUBLE) * CAST(b.c AS DOUBLE)) AS lift
FROM pairs p JOIN items a ON a.product_id = x JOIN items b ON b.product_id = y, n
WHERE p.c >= greatest(2, ceil(n / 100000.0))"""
    q["mart_rfm"] = """
SELECT *, CASE WHEN recency_days IS NULL THEN CASE WHEN frequency_orders > 0 THEN 'After analysis date' ELSE 'No completed purchase' END
               WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champion'
               WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal' WHEN r_score >= 4 AND f_score <= 2 THEN 'Recent'
               WHEN r_score <= 2 AND f_score >= 3 THEN 'At risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'Dormant' ELSE 'Regular' END AS rfm_segment
FROM rfm_scores"""
    q["customer_snapshots"] = "SELECT * FROM customer_snapshots"
    over = "(PARTITION BY category ORDER BY period{})"
    lag = lambda c, k=1: f"lag({c}, {k}) OVER {over.format('')}"
    frame = lambda rows: over.format(f" ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING")
    parts = [f"{lag('y', k)} AS lag_{k}" for k in (1, 2, 4, 52)]
    for rows in (4, 13):
        full = f"CASE WHEN count(*) OVER {frame(rows)} = {rows} THEN"
        parts.append(f"{full} CAST(sum(y) OVER {frame(rows)} AS DOUBLE) / {rows} END AS rolling_mean_{rows}")
        spread = f"CAST({rows} * sum(y * y) OVER {frame(rows)} - sum(y) OVER {frame(rows)} * sum(y) OVER {frame(rows)} AS DOUBLE)"
        parts.append(f"round({full} sqrt({spread} / {rows * (rows - 1)}) END, 9) AS rolling_std_{rows}")
    late = ("average_unit_price", "effective_discount_rate", "online_unit_share", "store_unit_share", "marketplace_unit_share")
    parts += [f"{lag(c)} AS {c}_lag_1" for c in late]
    promoted = "(CAST(promoted_order_count AS DOUBLE) / nullif(CAST(order_count AS DOUBLE), 0))"
    parts.append(f"round({lag(promoted)}, 9) AS promoted_share_lag_1")
    parts.append(f"round({lag('average_unit_price')} / nullif({lag('average_unit_price', 2)}, 0) - 1, 9) AS price_change")
    q["temporal_features"] = f"""
SELECT category, week_start, y AS target, {', '.join(parts)}, month(week_start) AS month_number, week(week_start) AS week_of_year,
       holiday_days, campaign_days
FROM weekly"""
    q["rolling_origin_splits"] = """
SELECT fold, first AS train_start, CAST(first + CAST(7 * (train_weeks - 1) AS INTEGER) AS DATE) AS train_end,
       CAST(first + CAST(7 * train_weeks AS INTEGER) AS DATE) AS test_start, CAST(first + CAST(7 * (train_weeks + 3) AS INTEGER) AS DATE) AS test_end, train_weeks
FROM folds"""
    q["fold_membership"] = """
SELECT category, week_start, period,
       (SELECT min(fold) FROM folds WHERE period < train_weeks) AS first_train_fold,
       (SELECT min(fold) FROM folds WHERE period BETWEEN train_weeks AND train_weeks + 3) AS first_test_fold,
       (SELECT max(fold) FROM folds WHERE period BETWEEN train_weeks AND train_weeks + 3) AS last_test_fold
FROM weekly"""
    q["forecast_baselines"] = "SELECT * FROM forecasts"
    q["forecast_errors"] = """
SELECT model, horizon, category, count(*) AS n, CAST(sum(abs(actual - forecast)) AS DOUBLE) / count(*) AS mae,
       round(avg(coalesce(CAST(2 * abs(actual - forecast) AS DOUBLE) / nullif(CAST(abs(actual) + abs(forecast) AS DOUBLE), 0), 0)), 9) AS smape
FROM forecasts GROUP BY ALL"""
    q["cohort_retention"] = "SELECT * FROM cohort_long"
    cells = ", ".join(f"max(retention) FILTER (age_months = {k}) AS age_{k:02d}" for k in range(25))
    q["cohort_retention_matrix"] = f"SELECT cohort_month, cohort_size, {cells} FROM cohort_long GROUP BY ALL"
    both = "FROM recency_scored JOIN mart_customer_360 USING (customer_id)"
    q["propensity_baselines"] = "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, {segment} AS segment, {_BRIER.format(p=p)} {both} GROUP BY 2"
        for model, p in (("majority", "majority"), ("recency", "probability"))
        for segment in ("'all'", "segment")
    )
    fine = "CAST(round(probability * 1000000000) AS BIGINT)"
    edges = ", ".join(f"{_edge(fine, k, 10, 'recency_scored')} AS c{k}" for k in range(1, 10))
    q["propensity_calibration"] = f"""
WITH c AS (SELECT {edges})
SELECT CAST({_part(fine, 'c{k}', 10)} AS BIGINT) AS part, {_BRIER.format(p='probability')}
FROM recency_scored, c GROUP BY 1"""
    return q
