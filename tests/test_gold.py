"""Star schema and marts on the small batch, against plain Python arithmetic."""

from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import CLEAN, as_dicts, make_batch
from pyspark.sql import functions as F

from ledgerlake.operators import quality, signals
from ledgerlake.plans import gold, marts
from ledgerlake.plans.staging import STAGING
from ledgerlake.schemas import SOURCE_TABLES, Vocabulary

D = Decimal


def cents(value):
    return value.quantize(D("0.01"), ROUND_HALF_UP)


@pytest.fixture(scope="module")
def star(spark):
    batch = make_batch(spark, CLEAN)
    staged = {}
    for t in SOURCE_TABLES:
        bronze = batch[t].withColumns(
            {"_load_id": F.lit("x"), "_source_file": F.lit(t), "_ingested_at": F.lit(None).cast("timestamp_ntz")}
        )
        staged[t] = STAGING[t](bronze)
    sales = gold.fact_sales(staged["order_items"], staged["orders"], staged["customers"]).cache()
    returns = gold.fact_returns(staged["returns"], sales).cache()
    dates = gold.dim_date(staged["calendar_events"]).cache()
    outcomes = marts.order_outcomes(sales, returns, dates)
    found = {
        "staged": staged,
        "sales": sales,
        "returns": returns,
        "dates": dates,
        "mart_executive": marts.mart_executive(sales, returns),
        "mart_customer_360": marts.mart_customer_360(gold.dim_customer(staged["customers"]), outcomes),
        "mart_cohort_base": marts.mart_cohort_base(outcomes),
        "mart_basket_base": marts.mart_basket_base(sales, returns, dates, gold.dim_product(staged["products"])),
        "mart_forecasting_base": marts.mart_forecasting_base(sales, returns, dates, gold.dim_product(staged["products"])),
    }
    return found


@pytest.fixture(scope="module")
def truth():
    """Lines and returns with amounts, computed by hand."""
    orders = {o[0]: o for o in CLEAN["orders"]}
    lines = {}
    for line, order, product, quantity, price, cost, rate in CLEAN["order_items"]:
        gross = cents(quantity * D(str(price)))
        discount = cents(gross * D(str(rate)))
        cogs = cents(quantity * D(str(cost)))
        lines[line] = dict(
            order=order, product=product, q=quantity, price=D(str(price)), cost=D(str(cost)), rate=D(str(rate)),
            gross=gross, discount=discount, net=gross - discount, cogs=cogs, profit=gross - discount - cogs,
            customer=orders[order][1], day=orders[order][2].date(), channel=orders[order][3], promo=orders[order][5],
        )
    back = {}
    for rid, line, day, quantity, _ in CLEAN["returns"]:
        x = lines[line]
        revenue = cents(quantity * x["price"] * (1 - x["rate"]))
        cogs = cents(quantity * x["cost"])
        back[rid] = dict(line=line, order=x["order"], product=x["product"], customer=x["customer"], q=quantity, revenue=revenue, cogs=cogs, impact=revenue - cogs, day=day, order_day=x["day"])
    return lines, back


def test_fact_sales(star, truth):
    lines, _ = truth
    for r in as_dicts(star["sales"]):
        x = lines[r["line_id"]]
        assert (r["gross_sales"], r["discount_amount"], r["net_sales"], r["cogs"], r["gross_profit"]) == (
            x["gross"], x["discount"], x["net"], x["cogs"], x["profit"],
        )
        assert (r["customer_id"], r["channel_key"], r["promotion_id"]) == (x["customer"], x["channel"], x["promo"])
        assert r["date_key"] == int(x["day"].strftime("%Y%m%d"))
    kinds = dict(star["sales"].dtypes)
    assert all(kinds[c] == "decimal(18,2)" for c in ("gross_sales", "discount_amount", "net_sales", "cogs", "gross_profit"))


def test_fact_returns(star, truth):
    _, back = truth
    rows = as_dicts(star["returns"])
    assert len(rows) == 3
    for r in rows:
        x = back[r["return_id"]]
        assert (r["returned_revenue"], r["reversed_cogs"], r["profit_impact"]) == (x["revenue"], x["cogs"], x["impact"])
        assert (r["return_date_key"], r["order_date_key"]) == tuple(int(d.strftime("%Y%m%d")) for d in (x["day"], x["order_day"]))


def test_dimensions(star):
    s = star["staged"]
    assert {r[0] for r in gold.dim_channel(s["orders"]).collect()} == {"Online", "Store", "Marketplace"}
    assert {r[0] for r in gold.dim_geography(s["customers"]).collect()} == {"Austin", "Boston"}
    assert {r[0] for r in gold.dim_payment_method(s["orders"]).collect()} == {"Credit Card", "Debit Card", "Digital Wallet"}
    assert gold.dim_promotion(s["promotions"]).columns == ["promotion_id", "promotion_type", "start_date", "end_date", "discount_policy"]
    assert gold.dim_product(s["products"]).count() == 4


def test_executive(star, truth):
    lines, back = truth
    (r,) = as_dicts(star["mart_executive"])
    total = lambda rows, key: sum(x[key] for x in rows.values())
    assert (r["sales_line_count"], r["order_count"], r["customer_count"], r["ordered_quantity"]) == (10, 6, 2, total(lines, "q"))
    assert (r["net_sales"], r["cogs"], r["gross_profit"]) == tuple(total(lines, k) for k in ("net", "cogs", "profit"))
    assert (r["return_event_count"], r["returned_quantity"], r["returned_revenue"]) == (3, 7, total(back, "revenue"))
    assert r["return_adjusted_revenue"] == total(lines, "net") - total(back, "revenue")
    assert r["return_adjusted_profit"] == total(lines, "profit") - total(back, "impact")


def test_executive_without_facts(star):
    (r,) = as_dicts(marts.mart_executive(star["sales"].limit(0), star["returns"].limit(0)))
    assert (r["sales_line_count"], r["order_count"], r["net_sales"], r["ordered_quantity"]) == (0, 0, None, None)
    assert (r["return_event_count"], r["returned_revenue"], r["return_adjusted_revenue"]) == (0, 0, None)


def test_customer_360(star, truth):
    lines, back = truth
    rows = {r["customer_id"]: r for r in as_dicts(star["mart_customer_360"])}
    assert set(rows) == {"C1", "C2", "C3"}
    c1 = rows["C1"]
    # O5 came back as a whole: it counts as an order but not as a purchase.
    assert (c1["order_count"], c1["completed_order_count"]) == (3, 2)
    assert (c1["first_purchase_date"], c1["last_purchase_date"]) == (date(2025, 1, 2), date(2025, 1, 8))
    net = sum(x["net"] for x in lines.values() if x["customer"] == "C1")
    revenue = sum(x["revenue"] for x in back.values() if x["customer"] == "C1")
    assert (c1["net_sales"], c1["returned_revenue"], c1["return_adjusted_value"]) == (net, revenue, net - revenue)
    c3 = rows["C3"]
    assert (c3["order_count"], c3["net_sales"], c3["first_purchase_date"], c3["return_adjusted_profit"]) == (0, 0, None, 0)


def test_cohorts(star):
    rows = {r["order_id"]: r for r in as_dicts(star["mart_cohort_base"])}
    assert set(rows) == {"O1", "O2", "O3", "O4", "O6"}
    o4 = rows["O4"]
    assert (o4["order_month"], o4["acquisition_cohort_month"], o4["months_since_acquisition"]) == (date(2025, 2, 1), date(2025, 1, 1), 1)
    assert (rows["O3"]["ordered_quantity"], rows["O3"]["returned_quantity"], rows["O3"]["retained_quantity"]) == (7, 2, 5)


def test_cohort_starts_at_the_first_completed_order(spark):
    rows = [
        ("A", "X", date(2025, 1, 31), 1, 1, D(5), D(5)),
        ("B", "X", date(2025, 2, 28), 2, 1, D(5), D(2)),
        ("C", "X", date(2025, 4, 1), 2, 0, D(5), D(0)),
    ]
    outcomes = spark.createDataFrame(
        rows, "order_id string, customer_id string, order_date date, ordered_quantity bigint, returned_quantity bigint, net_sales decimal(18,2), returned_revenue decimal(18,2)"
    )
    got = {r["order_id"]: (r["acquisition_cohort_month"], r["months_since_acquisition"]) for r in marts.mart_cohort_base(outcomes).collect()}
    assert got == {"B": (date(2025, 2, 1), 0), "C": (date(2025, 2, 1), 2)}


def test_baskets(star):
    rows = {(r["order_id"], r["product_id"]): r for r in as_dicts(star["mart_basket_base"])}
    assert set(rows) == {("O1", "P1"), ("O1", "P3"), ("O2", "P2"), ("O3", "P3"), ("O4", "P1"), ("O6", "P3"), ("O6", "P2")}
    assert (rows["O2", "P2"]["ordered_quantity"], rows["O1", "P3"]["remaining_quantity"]) == (3, 2)
    assert rows["O1", "P1"]["category"] == "Computers"


def test_forecasting_grid(star, truth):
    lines, back = truth
    category = {p[0]: p[2] for p in CLEAN["products"]}
    monday = lambda d: d - timedelta(days=d.weekday())
    rows = {(r["week_start"], r["category"]): r for r in as_dicts(star["mart_forecasting_base"])}
    days = [c[0] for c in CLEAN["calendar_events"]]
    assert set(rows) == {(monday(d), c) for d in days for c in ("Computers", "Accessories")}
    net, orders, units, returned = defaultdict(D), defaultdict(set), defaultdict(int), defaultdict(D)
    for x in lines.values():
        key = (monday(x["day"]), category[x["product"]])
        net[key] += x["net"]
        units[key] += x["q"]
        orders[key].add(x["order"])
    for x in back.values():
        returned[monday(x["order_day"]), category[x["product"]]] += x["revenue"]
    for key, r in rows.items():
        assert (r["net_sales"], r["ordered_quantity"], r["order_count"]) == (net[key], units[key], len(orders[key]))
        assert (r["returned_revenue"], r["return_adjusted_revenue"]) == (returned[key], net[key] - returned[key])
        if not orders[key]:
            assert r["average_unit_price"] is None and r["effective_discount_rate"] is None
            assert (r["online_unit_share"], r["promoted_order_count"]) == (0.0, 0)
    week = rows[date(2025, 1, 6), "Accessories"]
    assert (week["promoted_order_count"], week["marketplace_unit_share"], week["campaign_days"]) == (1, 1.0, 7)
    assert rows[date(2024, 12, 30), "Computers"]["holiday_days"] == 1


def test_marts_reconcile(star):
    checks = {r["check_name"]: r["violations"] for r in quality.mart_reconciliation(star["sales"], star["returns"], star).collect()}
    assert len(checks) == 7 and set(checks.values()) == {0}


def test_reconciliation_notices_deviations(star):
    broken = dict(star)
    broken["mart_executive"] = star["mart_executive"].withColumn("net_sales", F.col("net_sales") + D("0.02"))
    broken["mart_cohort_base"] = star["mart_cohort_base"].where("order_id <> 'O1'")
    broken["mart_basket_base"] = star["mart_basket_base"].withColumn("net_sales", F.col("net_sales") + D("0.02"))
    broken["mart_forecasting_base"] = star["mart_forecasting_base"].where("category <> 'Computers'")
    broken["mart_customer_360"] = star["mart_customer_360"].where("customer_id <> 'C1'")
    checks = {r["check_name"]: r["violations"] for r in quality.mart_reconciliation(star["sales"], star["returns"], broken).collect()}
    assert checks == {
        "executive_grain_or_totals": 1, "executive_row_count": 0, "customer_totals": 1, "cohort_population": 1,
        "cohort_measures": 1, "basket_measures": 7, "forecast_totals": 1,
    }


def test_financial_identities(star):
    assert quality.broken_identities(star["sales"], star["returns"]).count() == 0
    off = star["sales"].withColumn("gross_profit", F.when(F.col("line_id") == "L03", D(1)).otherwise(F.col("gross_profit")))
    assert [r["record_id"] for r in quality.broken_identities(off, star["returns"]).collect()] == ["L03"]


def test_singular_checks(star):
    s = star["staged"]
    assert quality.item_values_invalid(s["order_items"]).count() == 0
    assert quality.items_without_parents(s["order_items"], s["orders"], s["customers"], s["products"]).count() == 0
    fewer = quality.items_without_parents(s["order_items"], s["orders"].where("order_id <> 'O1'"), s["customers"].where("customer_id <> 'C2'"), s["products"].where("product_id <> 'P4'"))
    assert {r["line_id"] for r in fewer.collect()} == {"L01", "L02", "L05", "L06", "L07", "L08", "L09", "L10"}
    early = s["returns"].withColumn("return_date", F.lit(date(2025, 1, 3)))
    assert {r["return_id"] for r in quality.returns_before_order(early, s["order_items"], s["orders"]).collect()} == {"R2", "R3"}
    many = s["returns"].withColumn("returned_quantity", F.lit(4))
    assert {r["return_id"] for r in quality.returns_above_ordered(many, s["order_items"]).collect()} == {"R1", "R2"}


def test_generic_tests(star):
    s = star["staged"]
    models = {"stg_orders": s["orders"].unionByName(s["orders"].where("order_id = 'O1'")), "stg_customers": s["customers"].where("customer_id <> 'C2'")}
    tests = [
        quality.ModelTest("unique", "stg_orders", "order_id", "warn"),
        quality.ModelTest("not_null", "stg_orders", "promotion_id"),
        quality.ModelTest("accepted_values", "stg_orders", "channel", values=("Online",)),
        quality.ModelTest("relationships", "stg_orders", "customer_id", parent="stg_customers", parent_column="customer_id"),
        quality.ModelTest("unique", "stg_orders", "order_id || '|' || customer_id"),
    ]
    run = lambda f: [(r["column_name"], r["severity"], r["violations"]) for r in f(models, tests).collect()]
    assert run(quality.test_unique) == [("order_id", "warn", 1), ("order_id || '|' || customer_id", "error", 1)]
    assert run(quality.test_not_null) == [("promotion_id", "error", 6)]
    assert run(quality.test_accepted_values) == [("channel", "error", 2)]
    assert run(quality.test_relationships) == [("customer_id", "error", 3)]
    assert len(quality.declared_tests(Vocabulary())) > 100


def test_signals(star):
    s = star["staged"]
    assert {r["order_year"]: r["order_count"] for r in signals.yearly_orders(s["orders"]).collect()} == {2025: 6}
    share = {r["channel"]: r["share"] for r in signals.channel_share(s["orders"]).collect()}
    assert share == {"Online": 0.5, "Store": 2 / 6, "Marketplace": 1 / 6}
    (promo,) = as_dicts(signals.promotion_effect(s["orders"], s["order_items"]))
    assert (promo["promoted_orders"], promo["promoted_lines"], promo["promoted_discount"], promo["control_discount"]) == (1, 2, 0.1, None)
    affinity = {r["with_source"]: r["target_rate"] for r in signals.product_affinity(s["order_items"], ["P1"], "P3").collect()}
    assert affinity == {True: 0.5, False: 0.5}
    (loyal,) = as_dicts(signals.repeat_customers(s["orders"]))
    assert (loyal["single_purchase_customers"], loyal["repeat_customers"]) == (0, 2)
    (back,) = as_dicts(signals.partial_returns(s["returns"], s["order_items"]))
    assert (back["partial_returns"], back["full_returns"]) == (1, 2)
    assert signals.cross_week_returns(star["returns"], star["dates"]).first()[0] == 2
    (season,) = as_dicts(signals.season_lift(star["sales"], star["dates"]))
    assert (season["peak_revenue"], season["base_revenue"], season["lift"]) == (0, 0, None)
