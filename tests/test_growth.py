"""Steps whose shuffles grew faster than the input: what crosses a shuffle, and that results stay."""

from datetime import date

import pytest
from conftest import edit, make_batch
from pyspark.sql import functions as F

from ledgerlake import session, workbench
from ledgerlake.analytics import churn, cohorts
from ledgerlake.operators import bitmaps, contracts, quality, signals
from ledgerlake.operators.contracts import validate_sources
from ledgerlake.plans import conform, marts
from ledgerlake.plans.lake import Lake
from ledgerlake.workbench import Workbench


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_joined_with_rejected_rows_only(spark, data, tmp_path):
    """Accepted parents, which grow with the input, are no side of a join of whole lines."""
    edit(data, "customers", 1, segment="Nobody")
    lake = Lake(spark, str(tmp_path / "lake"))
    batch = make_batch(spark, data)
    lake.ingest(batch, validate_sources(batch, "a"), "a")
    silver = lake.build_silver("a")
    for model in conform.CHILDREN:
        plan = _plan(lake.conformed(model, "a", silver))
        assert plan.count("Join ") == plan.count("Join LeftAnti") == 2
    assert {r.order_id for r in silver["orders"].collect()} == {"O1", "O2", "O5"}
    assert {r.line_id for r in silver["order_items"].collect()} == {"L01", "L02", "L03", "L04", "L08"}
    assert {r.return_id for r in silver["returns"].collect()} == {"R1", "R3"}


@pytest.mark.parametrize("few", [100_000, 0])
def test_repeated_keys_are_exact_whether_few_or_many(spark, monkeypatch, few):
    monkeypatch.setattr(contracts, "FEW_REPEATS", few)
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,), ("c",), ("a",)], "k string")
    found = {(r.k, r.copies) for r in contracts._written_repeats(df, "k").collect()}
    assert found == {("a", 3), (None, 2)}


def test_orphan_returns_are_found_where_lines_repeat(spark, data):
    """The key of lines is judged by the lookup of the other rules, and by itself where that lookup is skipped."""
    data["returns"].append(("R9", "nowhere", *data["returns"][0][2:]))
    for repeated in (False, True):
        if repeated:
            data["order_items"].append(data["order_items"][0])
        findings = contracts.table_findings(make_batch(spark, data), "returns")
        orphans = findings.where(F.col("check_name") == "line_id_foreign_key").collect()
        assert [(r.source_row, r.failure_case) for r in orphans] == [(3, "nowhere")]


def test_a_mart_writes_nothing_but_what_it_reads(spark, monkeypatch):
    w = Workbench(spark, "", "")
    asked = []
    monkeypatch.setattr(w, "mart", lambda name: asked.append(name) or spark.range(1))
    monkeypatch.setattr(w, "_saved", lambda area, plans: plans)
    w.written_mart("mart_cohort_base")
    w.written_mart("mart_cohort_base")
    assert asked == ["mart_cohort_base"]


def test_no_whole_row_is_shuffled_to_be_rejected(spark, data, tmp_path):
    """Rejected rows are met as bitmaps, whatever their number; accepted tables are views over bronze."""
    edit(data, "customers", 1, segment="Nobody")
    lake = Lake(spark, str(tmp_path / "lake"))
    batch = make_batch(spark, data)
    lake.ingest(batch, validate_sources(batch, "a"), "a")
    silver = lake.build_silver("a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for model in conform.CHILDREN:
            plan = lake.conformed(model, "a", silver)._jdf.queryExecution().sparkPlan().toString()
            assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not lake.exists(lake.path("silver", "int_order_items"))


def test_returns_meet_few_other_lines(spark):
    """Lines that did not come back stay out of the shuffle of the lookup."""
    items = spark.range(5000).selectExpr("concat('L', id) AS line_id", "id AS quantity", "'O1' AS order_id")
    returns = spark.range(100).selectExpr("concat('L', id * 50) AS line_id", "id * 50 - 1 AS returned_quantity")
    assert bitmaps.maybe_in(items, "line_id", returns).count() < 1000
    assert _plan(quality.returns_above_ordered(returns, items)).count("_bits") > 0
    assert signals.partial_returns(returns, items).first().partial_returns == 100


def test_amounts_are_summed_in_cents(spark):
    df = spark.createDataFrame([("a", "0.10"), ("a", "9999999999999999.89"), ("b", "-0.05"), ("c", None)], "k string, m string")
    summed = df.selectExpr("k", "CAST(m AS DECIMAL(18,2)) AS m").groupBy("k").agg(marts.total("m"))
    assert {r.k: r.m and str(r.m) for r in summed.collect()} == {"a": "9999999999999999.99", "b": "-0.05", "c": None}
    assert summed.schema["m"].dataType.simpleString() == "decimal(18,2)"
    assert "decimal(28,2)" not in _plan(summed) and "sum(m" not in _plan(summed)


def test_facts_are_written_without_amounts_that_follow(spark, data, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    batch = make_batch(spark, data)
    lake.ingest(batch, validate_sources(batch, "a"), "a")
    facts = lake.build_facts("a", lake.build_silver("a"))
    assert "net_sales" in facts["fact_sales"].columns and "net_sales" not in lake.table("gold", "fact_sales", "a").columns
    assert "profit_impact" in facts["fact_returns"].columns and "profit_impact" not in lake.table("gold", "fact_returns", "a").columns


def test_orphans_are_found_by_different_keys(spark, data):
    """A key of many rows is looked up once, and each of its rows is found."""
    for n in range(3):
        data["order_items"].append((f"X{n}", "nowhere", *data["order_items"][0][2:]))
    batch = make_batch(spark, data)
    fk = next(k for k in contracts.FOREIGN_KEYS if k.name == "order_id_foreign_key")
    found = contracts.foreign_key_findings(batch, fk)
    rows = len(data["order_items"])
    assert sorted(r.source_row for r in found.collect()) == [rows - 3, rows - 2, rows - 1]


def test_hashes_grow_with_the_rows():
    assert [contracts._hash_bits(n) for n in (0, 10**6, 2 * 10**8, 10**10, 10**13)] == [40, 40, 40, 52, 64]


def _bench(spark, data, folder):
    """A workbench over literal rows, loaded, with no fact written."""
    w = Workbench(spark, "", str(folder / "w"))
    w.batch = make_batch(spark, data)
    w.load = w.lake.ingest(w.batch, validate_sources(w.batch, "a"), "a")
    return w


def _steps(df):
    return [line for line in _plan(df).splitlines() if "Relation [" not in line]


def test_retention_reads_no_amounts(spark, data, tmp_path):
    """Retention counts customers by month: no fact, order total or mart is written for it, and no line key or amount of a sale is read."""
    w = _bench(spark, data, tmp_path)
    months = w.purchase_months()
    assert not {"gold", "outcomes"} & set(w.__dict__) and not w._marts and not w.lake.exists(w.lake.path("gold", "fact_sales", "a"))
    assert len(_steps(months)) > 5 and not any("net_sales" in line or "unit_price" in line for line in _steps(months))
    found = cohorts.retention(months).collect()
    assert found and sorted(found) == sorted(cohorts.retention(w.mart("mart_cohort_base")).collect())
    assert "outcomes" in w.__dict__ and sorted(cohorts.retention(w.purchase_months()).collect()) == sorted(found)


def test_snapshots_write_few_columns(spark, data, tmp_path, monkeypatch):
    w = _bench(spark, data, tmp_path)
    cutoffs, written = [date(2025, 1, 31), date(2025, 3, 31)], []
    w.silver, w._fact_plans
    monkeypatch.setattr(workbench, "stored", lambda df: written.append(df.columns) or df)
    monkeypatch.setattr(churn, "quarter_ends", lambda first, last: cutoffs)
    narrow = w.snapshots.collect()
    assert written == [list(churn.RETURN_COLUMNS), list(churn.ORDER_COLUMNS)] and not {"gold", "outcomes"} & set(w.__dict__)
    events = churn.customer_events(w.outcomes, w.gold["fact_returns"])
    whole = churn.build_customer_snapshots(events, cutoffs, churn.HORIZON_DAYS, w.batch.end_date)
    assert narrow and sorted(narrow) == sorted(whole.collect())


def test_executive_reads_facts_as_plans(spark, data, tmp_path):
    """Line and product keys of sales stay behind; lines that did not come back are dropped before the join with orders."""
    w = _bench(spark, data, tmp_path)
    mart = w.mart("mart_executive")
    assert "gold" not in w.__dict__ and not any("product_id" in line for line in _steps(mart))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = w.facts_read()["fact_returns"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lookup = next(depth(line) for line in plan if "Join Inner, (order_id" in line)
    assert any("Join LeftSemi" in line and depth(line) > lookup for line in plan)
    (planned,), (written,) = mart.collect(), marts.mart_executive(w.gold["fact_sales"], w.gold["fact_returns"]).collect()
    assert planned == written and planned.sales_line_count > 0


def _hint(df):
    return "strategy=merge" in df._jdf.queryExecution().analyzed().toString()


def test_tables_of_many_rows_are_not_broadcast(spark, data, tmp_path, monkeypatch):
    """Files of keys are far smaller than their rows in memory: the number of rows decides, wherever parents are looked up."""
    keys = spark.range(30).selectExpr("concat('C', id) AS customer_id")
    assert not _hint(session.sized(keys))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    assert _hint(session.sized(keys)) and not _hint(session.sized(keys.limit(1)))
    w = _bench(spark, data, tmp_path)
    s = w.silver
    parents = (s["orders"], s["customers"], s["products"])
    tests = [t for t in quality.declared_tests(w.batch.vocabulary) if t.test == "relationships" and t.model == "int_order_items"]
    facts = w._fact_plans
    asked = {
        "items": quality.items_without_parents(w.staged("order_items"), *parents),
        "tests": quality.test_relationships(w.models(), tests),
        "sales": facts["fact_sales"],
        "basket": w.mart("mart_basket_base"),
        "weeks": marts.category_weeks_of_sales(facts["fact_sales"], facts["dim_date"], s["products"]),
    }
    looked_up = {"items": 5, "tests": 2, "sales": 1, "basket": 1, "weeks": 1}
    for name, df in asked.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("rightHint=(strategy=merge)") >= looked_up[name], name
    rows = {name: sorted(map(repr, df.collect())) for name, df in asked.items()}
    monkeypatch.undo()
    again = quality.items_without_parents(w.staged("order_items"), *parents)
    assert rows["items"] == sorted(map(repr, again.collect())) and rows["sales"] == sorted(map(repr, w.gold["fact_sales"].collect()))
    assert rows["basket"] == sorted(map(repr, w.mart("mart_basket_base").collect()))


def test_a_test_builds_the_models_it_tests(spark, data, tmp_path):
    """Relationships are declared on silver tables, dimensions and facts: no mart is built for them."""
    w = _bench(spark, data, tmp_path)
    models = w.models()
    found = quality.test_relationships(models, quality.declared_tests(w.batch.vocabulary)).collect()
    assert len(found) == 22 and sum(r.violations for r in found) == 0
    assert not w._marts and "outcomes" not in w.__dict__ and "written_rejected" not in w.__dict__
    assert len(models) == len(set(models)) == 29 and models["mart_executive"].count() == 1 and list(w._marts) == ["mart_executive"]


def test_marts_of_products_read_facts_as_plans(spark, data, tmp_path):
    w = _bench(spark, data, tmp_path)
    planned = {name: sorted(map(repr, w.mart(name).collect())) for name in ("mart_basket_base", "mart_forecasting_base")}
    assert "gold" not in w.__dict__
    w.gold
    assert all(rows and rows == sorted(map(repr, w.mart(name).collect())) for name, rows in planned.items())
