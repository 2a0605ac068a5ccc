import random
import statistics
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import as_dicts, table_of
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import number_or_null, strip, timestamp_or_null, title_case
from ledgerlake.operators import cleaning, groups, kpi, profile, slices
from ledgerlake.operators.groups import attach_group_value, exact_median, fill_from_group, hot_groups, in_slices, lookup_where, value_counts
from ledgerlake.plans.sheet import run_sheet_pipeline
from ledgerlake.schemas import FLAT_COLUMNS, FLAT_SCHEMA, PAYMENT_METHODS, PRODUCT_CATEGORIES, SOURCE_ROW, with_source_row
from ledgerlake.workbench import Workbench

D = Decimal
SCHEMA = with_source_row(FLAT_SCHEMA)


def line(i, order, **changes):
    row = {
        "Order_Line_ID": f"L{i}",
        "Order_ID": order,
        "Order_Date": "2025-03-01",
        "Customer_ID": "C1",
        "Product": "Laptop",
        "Category": "Computers",
        "City": "Austin",
        "Quantity": "2",
        "Unit_Price_USD": 100.0,
        "Discount_Rate": 0.1,
        "Payment_Method": "Credit Card",
    }
    return {**row, **changes}


DIRTY = [
    line(1, "A"),
    line(2, "A", City=None, Product="Monitor", Unit_Price_USD=50.0),
    line(3, "B", City=None, Payment_Method=None),
    line(4, "C", City="  Austin ", Payment_Method="  credit CARD"),
    line(5, "C", City="aUSTIN", Payment_Method="barter"),
    line(6, "D", Quantity="0"),
    line(7, "D", Quantity="-1"),
    line(8, "D", Quantity="three", Order_Date="2025-05-05"),
    line(9, "E", Unit_Price_USD=0.0),
    line(10, "E", Unit_Price_USD=-25.0, Product="Monitor"),
    line(11, "E", Unit_Price_USD=101.0),
    line(12, "F", Discount_Rate=-0.1),
    line(13, "F", Discount_Rate=1.2),
    line(14, "F", Discount_Rate=None),
    line(15, "G", Order_Date="not-a-date"),
    line(16, "G", Order_Date="2025-04-04"),
    line(17, "H", Order_Date="2025-13-40"),
    line(18, "H", Order_Date="31/31/2025"),
    line(19, "H", Order_Date="2024-12-31"),
    line(20, "D", Order_Date="2024-12-31"),
    line(21, "I", Category="Audio"),
    line(22, "I", Quantity=" 3 ", Category=" Computers "),
    line(1, "A"),
]


def sheet(spark, rows=DIRTY):
    names = SCHEMA.fieldNames()
    return table_of(spark, [tuple([*[r[n] for n in names[:-1]], i]) for i, r in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def judged(spark):
    return cleaning.judged_sheet(sheet(spark), cleaning.CleaningRules()).cache()


@pytest.fixture(scope="module")
def clean(judged):
    return {r["Order_Line_ID"]: r for r in as_dicts(cleaning.cleaned_rows(judged))}


def test_rows_kept(clean):
    assert set(clean) == {f"L{i}" for i in (1, 2, 3, 4, 5, 9, 10, 11, 15, 16, 21, 22)}


def test_text_and_order_level_values(clean):
    assert clean["L2"]["City"] == "Austin"
    assert (clean["L3"]["City"], clean["L3"]["Payment_Method"]) == ("Unknown", "Unknown")
    assert {clean[i]["City"] for i in ("L4", "L5")} == {"Austin"}
    assert {clean[i]["Payment_Method"] for i in ("L4", "L5")} == {"Credit Card"}


def test_values(clean):
    assert clean["L22"]["Quantity"] == 3
    # Median of the valid laptop prices with a valid quantity: mostly 100 and one 101.
    assert clean["L9"]["Unit_Price_USD"] == D("100.0000")
    assert clean["L10"]["Unit_Price_USD"] == D("50.0000")
    assert clean["L15"]["Order_Date"] == datetime(2025, 4, 4)
    assert {clean[i]["Category"] for i in ("L21", "L22")} == {"Computers"}


def test_log(judged):
    log = [(r["Step"], r["Rows_Affected"], r["Decision"]) for r in cleaning.cleaning_log(judged).collect()]
    assert log == [
        ("Remove exact duplicates", 1, "Removed completely identical rows"),
        ("Handle missing City", 2, "Recovered 1 from the same order; labeled 1 as Unknown"),
        ("Handle missing Payment_Method", 2, "Recovered 1 from the same order; labeled 1 as Unknown"),
        ("Validate quantity", 3, "Removed rows with non-numeric, zero, or negative quantity"),
        ("Repair unit prices", 2, "Replaced with median valid price for the same product"),
        ("Validate discount rates", 3, "Removed rows with discount rates outside 0-1"),
        # The other lines of order D fell to their quantity, so its last date cannot be recovered.
        ("Validate order dates", 5, "Recovered 1 from the same order; removed 4 unrecoverable rows"),
        ("Correct product categories", 1, "Replaced with the approved category for each product"),
    ]


def test_postconditions(spark, judged):
    rules = cleaning.CleaningRules()
    result = cleaning.postconditions(cleaning.cleaned_rows(judged), rules).collect()
    assert len(result) == 8 and {r["violations"] for r in result} == {0}
    raw = cleaning.parse_values(sheet(spark), rules).drop("Order_Date").withColumnRenamed("_date", "Order_Date")
    dirty = {r["rule"]: r["violations"] for r in cleaning.postconditions(raw, rules).collect()}
    assert dirty["Exact duplicates remain"] == dirty["Line IDs are duplicated"] == 1
    assert dirty["Product/category mismatches remain"] == 2
    assert dirty["Invalid discounts remain"] == 2 and dirty["Invalid prices remain"] == 2


def test_category_table_gives_the_same_rows_as_a_dict(spark, judged):
    table = spark.createDataFrame(list(PRODUCT_CATEGORIES.items()), "Product string, Category string")
    other = cleaning.judged_sheet(sheet(spark), cleaning.CleaningRules(categories=table))
    assert other.exceptAll(judged.select(other.columns)).count() == 0


def neighbours(rows):
    """Nearest earlier value of the group, else nearest later one, row by row."""
    filled = []
    for key, position, value in rows:
        group = sorted((p, v) for k, p, v in rows if k == key and v is not None)
        before = [v for p, v in group if p <= position]
        after = [v for p, v in group if p > position]
        filled.append((key, position, before[-1] if before else (after[0] if after else None)))
    return sorted(filled, key=repr)


@pytest.mark.parametrize("limit", [2, 5, 1000])
def test_fill_is_the_same_whether_groups_are_sliced_or_not(spark, limit):
    rng = random.Random(limit)
    rows = [
        (rng.choice(["big", "big", "big", "mid", "mid", "small", "empty"]), i, rng.choice([None, None, "x", "y", "z"]))
        for i in range(90)
    ]
    rows = [(k, i, None if k == "empty" else v) for k, i, v in rows]
    df = spark.createDataFrame(rows, "k string, i long, v string")
    hot = hot_groups(df, "k", "i", limit)
    assert hot.count() == len({k for k, _, _ in rows if sum(r[0] == k for r in rows) > limit})
    result = fill_from_group(df, "k", "i", {"v": F.col("v")}, hot)
    assert sorted((tuple(r) for r in result.select("k", "i", "v").collect()), key=repr) == neighbours(rows)


def test_slices_have_equal_numbers_of_rows(spark):
    """One row far from all others: slices are cut by rows, not by positions."""
    rows = [("k", 0, None)] + [("k", 1_000_000 + i, "x" if i == 150 else None) for i in range(200)] + [("cold", 5, None)]
    df = spark.createDataFrame(rows, "k string, i long, v string")
    hot = hot_groups(df, "k", "i", 10)
    sizes = [r["count"] for r in in_slices(df, "k", "i", hot).groupBy("_slice").count().collect()]
    assert sum(sizes) == 201 and max(sizes) == 10 and len(sizes) == 21
    result = fill_from_group(df, "k", "i", {"v": F.col("v")}, hot)
    assert sorted((tuple(r) for r in result.select("k", "i", "v").collect()), key=repr) == neighbours(rows)


def test_only_groups_that_lack_something_are_sorted(spark):
    """Complete rows pass beside the window, and a group without gaps never reaches it."""
    rows = [(f"k{i % 50}", i, None if i in (7, 57) else "x") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long, v string").withColumn("other", F.lit(1))
    result = fill_from_group(df, "k", "i", {"v": F.col("v")}, hot_groups(df, "k", "i", 1000))
    assert result.count() == 500 and result.where("v is null").count() == 0
    window = next(line for line in result._jdf.queryExecution().analyzed().toString().splitlines() if "Window" in line)
    assert "other" not in window


def test_close_values_are_ranked_in_many_ranges(spark):
    """Values within 0.01 % of each other are dealt out by their number, and rank as in plain Python."""
    df = spark.range(20_000).select(F.lit("a").alias("g"), (10_000_000 + F.col("id") % 1000).cast("decimal(18,4)").alias("x"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        dealt = slices._in_ranges(value_counts(df, "g", "x"), ["g"], "x")
        assert max(r["count"] for r in dealt.groupBy("_range").count().collect()) < 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert exact_median(df, "g", "x").first()["median"] == D("10000499.5")


def test_rows_without_a_group_keep_their_own_value(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, None), ("k", 3, "b")], "k string, i long, v string")
    for limit in (1, 100):
        result = fill_from_group(df, "k", "i", {"v": F.col("v")}, hot_groups(df, "k", "i", limit))
        assert [r["v"] for r in result.orderBy("i").collect()] == ["a", None, "b"]


def test_median_matches_python(spark):
    rng = random.Random(7)
    rows = [(g, D(rng.choice([1, 10, 1000, 100000]) * rng.randint(-50, 300)) / 100) for g in "abcd" for _ in range(rng.randint(1, 60))]
    rows.append(("a", None))
    df = spark.createDataFrame(rows, "g string, x decimal(18,4)")
    got = {r["g"]: r["median"] for r in exact_median(df, "g", "x").collect()}
    assert got == {g: statistics.median([x for k, x in rows if k == g and x is not None]) for g in "abcd"}


def test_lookup_only_where_needed(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "a", False), (3, None, True), (4, "b", None), (5, "z", True)], "i int, k string, need boolean")
    table = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    rows = lookup_where(df, F.col("need"), "k", table, "v", "found", spread="i").orderBy("i").collect()
    assert [r["found"] for r in rows] == [10, None, None, None, None]


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_group_values_reach_hot_and_other_rows(spark, limit):
    rows = [(i, k) for i, k in enumerate("aaaaabbc")] + [(90, None), (91, "z")]
    df = spark.createDataFrame(rows, "i int, k string")
    groups = df.where("k is not null and k <> 'z'").groupBy("k").agg(F.count("*").alias("n"))
    got = attach_group_value(df, "k", groups, "n", "n", spread="i", rows=limit).orderBy("i").collect()
    assert [r["n"] for r in got] == [5] * 5 + [2] * 2 + [1] + [None, None]
    empty = attach_group_value(df, "k", groups.limit(0), "n", "n", spread="i", rows=limit)
    assert {r["n"] for r in empty.collect()} == {None} and empty.count() == 10


@pytest.mark.parametrize(
    "text",
    ["new york", "SAN FRANCISCO", "saint-john", "o'neil's", "l'été", "3rd street", "a  b", "", "winston-SALEM nc"],
)
def test_title_case_like_python(spark, text):
    row = spark.range(1).select(title_case(F.lit(text)).alias("t")).first()
    assert row["t"] == text.title()


def test_coercion(spark):
    texts = ["3", " 4 ", "2.5", "1e2", "three", "", "5d", "0x1", "-1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(number_or_null(F.col("t"))).collect()] == [3, 4, 2.5, 100, None, None, None, None, -1, None]
    dates = ["2025-03-01", "2025-03-01 10:30:00", "not-a-date", "2025-13-40", "31/31/2025", None]
    df = spark.createDataFrame([(t,) for t in dates], "t string")
    assert [r[0] for r in df.select(timestamp_or_null(F.col("t"))).collect()] == [
        datetime(2025, 3, 1), datetime(2025, 3, 1, 10, 30), None, None, None, None,
    ]
    df = spark.createDataFrame([("\t a b \n",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "a b"


# --- KPIs -------------------------------------------------------------------------------------------


def test_kpis_by_hand(spark):
    rows = [
        line(1, "A", Quantity="3", Unit_Price_USD=33.35, Discount_Rate=0.05),
        line(2, "A", Product="Desk Lamp", Category="Furniture", Quantity="10", Unit_Price_USD=20.0, Discount_Rate=0.0),
        line(3, "B", City="Boston", Unit_Price_USD=70.0, Discount_Rate=0.0, Order_Date="2025-04-01", Payment_Method="PayPal"),
        line(4, "C", City=None, Unit_Price_USD=500.0, Discount_Rate=0.0, Payment_Method="PayPal"),
    ]
    clean = cleaning.cleaned_rows(cleaning.judged_sheet(sheet(spark, rows), cleaning.CleaningRules()))
    lines = kpi.add_calculated_columns(clean).cache()
    first = lines.where("Order_Line_ID = 'L1'").first()
    assert (first["Gross_Sales_USD"], first["Discount_Amount_USD"], first["Net_Revenue_USD"]) == (D("100.05"), D("5.00"), D("95.05"))
    assert (first["Year"], first["Month"], first["Month_Name"]) == (2025, "2025-03", "March")
    tables = {name: as_dicts(df) for name, df in kpi.analysis_tables(lines).items()}
    laptop, lamp = tables["Product_Analysis"]
    assert (laptop["Product"], laptop["Units_Sold"], laptop["Orders"], laptop["Net_Revenue_USD"]) == ("Laptop", 7, 3, D("1235.05"))
    assert (laptop["Average_Order_Value_USD"], laptop["Revenue_Share_Pct"]) == (D("411.68"), D("86.06"))
    assert lamp["Revenue_Share_Pct"] == D("13.94")
    assert [r["Month"] for r in tables["Monthly_Sales"]] == ["2025-03", "2025-04"]
    summary = {r["Metric"]: r["Value"] for r in kpi.kpi_summary(lines).collect()}
    assert summary == {
        "Total Gross Sales (USD)": "1440.05",
        "Total Discount (USD)": "5.00",
        "Total Net Revenue (USD)": "1435.05",
        "Total Orders": "3",
        "Total Units Sold": "17",
        "Average Order Value (USD)": "478.35",
        "Average Selling Price (USD)": "84.41",
        "Effective Discount Rate (%)": "0.35",
        "Top-Selling Product": "Desk Lamp",
        "Highest-Revenue Product": "Laptop",
        "Highest-Revenue Category": "Computers",
        "Highest-Revenue City": "Austin",
        "Best Revenue Month": "2025-03",
        "Most-Used Payment Method": "PayPal",
    }
    assert all(r["reconciled"] for r in kpi.reconcile_tables(lines).collect())


def test_pipeline_writes_its_outputs(spark, tmp_path):
    out = run_sheet_pipeline(sheet(spark), cleaning.CleaningRules(), str(tmp_path / "out"))
    result = out.result.first()
    assert (result["raw_rows"], result["clean_rows"], result["unique_orders"]) == (23, 12, 6)
    for name in ("Summary", "Cleaned_Data", "Monthly_Sales", "Product_Analysis", "Category_Analysis", "City_Analysis", "Payment_Analysis"):
        assert spark.read.parquet(str(tmp_path / "out" / "report" / name)).count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "cleaned" / "Cleaning_Log")).count() == 8


# --- profile ----------------------------------------------------------------------------------------


def test_profile(spark):
    raw = sheet(spark)
    shape = profile.table_shape(raw, "Order_ID").first()
    assert (shape["row_count"], shape["unique_keys"], shape["column_count"]) == (23, 9, 11)
    assert {r["column_name"]: r["missing"] for r in profile.missing_values(raw).collect()} == {
        "City": 2, "Payment_Method": 1, "Discount_Rate": 1,
    }
    duplicates = profile.duplicated_rows(raw)
    assert sorted(r["_source_row"] for r in duplicates.collect()) == [0, 22]
    assert "to_json" not in duplicates._jdf.queryExecution().toString()
    counts = {r["value"]: r["n"] for r in profile.value_counts(raw, "City").collect()}
    assert (counts[None], counts["Austin"]) == (2, 19)
    assert profile.column_conformance(raw.drop("City").withColumn("Extra", F.lit(1))) == {"missing": ["City"], "unexpected": ["Extra"]}
    summary = {r["Quality_Check"]: r["Issue_Count"] for r in profile.quality_summary(raw, cleaning.CleaningRules(), ["Austin"]).collect()}
    assert summary == {
        "Exact duplicate rows": 1,
        "Duplicate Order_Line_ID values": 1,
        "Missing city values": 2,
        "Missing payment methods": 1,
        "Non-standard city values": 2,
        "Non-numeric quantities": 1,
        "Zero or negative quantities": 2,
        "Zero or negative unit prices": 2,
        "Discount rates outside 0-1": 3,
        "Unparseable order dates": 3,
        "Dates outside scope": 2,
        "Product/category mismatches": 2,
    }


def test_numeric_summary_matches_pandas(spark):
    import pandas as pd

    rng = random.Random(3)
    frame = pd.DataFrame({"a": [rng.choice([-3.5, 0.0, 1e-9, 2.25, 7e8, rng.random()]) for _ in range(57)], "b": [float(i) for i in range(57)]})
    frame.loc[5, "a"] = None
    table = spark.createDataFrame([(None if pd.isna(a) else float(a), b) for a, b in frame.itertuples(index=False)], "a double, b double")
    got = {r["column_name"]: r for r in profile.numeric_summary(table).collect()}
    want = frame.describe()
    for column in "ab":
        row = got[column]
        assert row["value_count"] == want[column]["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert row[mine] == pytest.approx(want[column][theirs])


def test_special_values_do_not_break_the_summary(spark):
    inf, nan = float("inf"), float("nan")
    table = spark.createDataFrame([(1.0, 1.0), (2.0, inf), (3.0, -inf), (nan, 2.0)], "a double, b double")
    got = {r["column_name"]: r for r in profile.numeric_summary(table).collect()}
    assert (got["a"]["value_count"], got["a"]["q50"], got["a"]["q75"]) == (3, 2.0, 2.5)
    assert (got["b"]["min"], got["b"]["q50"], got["b"]["max"]) == (-inf, 1.5, inf)


def test_prices_and_rates_keep_their_digits(spark):
    rows = [line(1, "A", Quantity="1", Unit_Price_USD=100_000.0, Discount_Rate=0.33333), line(2, "B", Quantity="50000", Unit_Price_USD=0.00004, Discount_Rate=0.0)]
    columns = SCHEMA.fieldNames()
    raw = table_of(spark, [tuple({**r, "_source_row": i}[c] for c in columns) for i, r in enumerate(rows)], SCHEMA)
    clean = cleaning.cleaned_rows(cleaning.judged_sheet(raw, cleaning.CleaningRules()))
    assert all(r["violations"] == 0 for r in cleaning.postconditions(clean, cleaning.CleaningRules()).collect())
    found = {r["Order_ID"]: (r["Discount_Amount_USD"], r["Gross_Sales_USD"]) for r in kpi.add_calculated_columns(clean).collect()}
    assert found == {"A": (D("33333.00"), D("100000.00")), "B": (D("0.00"), D("2.00"))}


def test_vocabularies():
    assert len(PRODUCT_CATEGORIES) == 12 and len(PAYMENT_METHODS) == 4


def _shuffled(df):
    """The lines of a plan that send rows from task to task."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_lines_that_stand_alone_are_not_shuffled(spark):
    """Only lines whose hash repeats, and the few that a filter takes for such, are grouped whole; NULLs are equal."""
    plain = lambda i: (f"L{i}", f"O{i // 4}", "2025-01-02", "C1", "Mouse", None, "Austin", "1", 9.5, 0.0, None if i % 2 else "Cash")
    rows = [plain(i) for i in range(2000)] + [plain(7), plain(8), plain(7)]
    raw = table_of(spark, [(*row, i) for i, row in enumerate(rows)], SCHEMA)
    found = cleaning.drop_exact_duplicates(raw)
    assert found.columns == [*FLAT_COLUMNS, SOURCE_ROW, "_copies"]
    copies = {r[SOURCE_ROW]: r["_copies"] for r in found.collect()}
    assert copies == {i: {7: 3, 8: 2}.get(i, 1) for i in range(2000)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Join LeftSemi") == plan.count("Join LeftAnti") == 1
    merged = raw.groupBy(*FLAT_COLUMNS).agg(F.min(SOURCE_ROW).alias(SOURCE_ROW), F.count("*").alias("_copies"))
    assert found.exceptAll(merged).count() == merged.exceptAll(found).count() == 0


def test_groups_without_gaps_are_not_shuffled(spark):
    """Rows of other groups than those in which a row lacks something meet a filter of keys before any shuffle."""
    rows = [(f"k{i // 4}" if i % 50 else None, i, None if i in (7, 2001) else "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, i long, v string")
    result = fill_from_group(df, "k", "i", {"v": F.col("v")}, hot_groups(df, "k", "i", 1000))
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "_bits" in plan.split("Window", 1)[1] and "Aggregate" not in plan
    assert sorted((tuple(r) for r in result.select("k", "i", "v").collect() if r.k), key=repr) == [r for r in neighbours(rows) if r[0]]


def test_groups_are_counted_by_bucket_first(spark):
    """Two groups of one bucket that are hot only together are none of them hot; a NULL group never is."""
    rows = [(k, i) for k in ("a", "b") for i in range(30)] + [("c", i) for i in range(50)] + [(None, i) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, i long")
    for buckets in (1, groups.HOT_BUCKETS):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(groups, "HOT_BUCKETS", buckets)
            assert [(r.k, r.slice_rows) for r in hot_groups(df, "k", "i", 40).collect()] == [("c", 40)]
    sizes = [line for line in _shuffled(hot_groups(df, "k", "i", 40)) if "(k#" in line]
    assert len(sizes) == 1 and "_bucket" in hot_groups(df, "k", "i", 40)._jdf.queryExecution().optimizedPlan().toString()


def test_grouped_tables_shuffle_no_amounts_by_order(spark):
    """Orders are counted apart from sums; NULL groups and NULL orders are counted as by COUNT(DISTINCT)."""
    rows = [("a", "O1", 1, "1.10"), ("a", "O1", 2, "2.20"), ("a", None, 3, "0.05"), (None, "O1", 4, "4.00"), (None, "O2", None, None), ("b", None, 1, "1.00")]
    money = ("Gross_Sales_USD", "Discount_Amount_USD", "Net_Revenue_USD")
    lines = spark.createDataFrame(rows, "City string, Order_ID string, Quantity long, m string").selectExpr(
        "City", "Order_ID", "Quantity", *[f"CAST(m AS DECIMAL(18,2)) AS {c}" for c in money]
    )
    table = kpi.build_grouped_analysis(lines, ("City",))
    found = {r.City: (r.Units_Sold, r.Orders, str(r.Net_Revenue_USD), str(r.Average_Order_Value_USD)) for r in table.collect()}
    assert found == {"a": (6, 1, "3.35", "3.35"), None: (4, 2, "4.00", "2.00"), "b": (1, 0, "1.00", "None")}
    plan = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
    by_order = [line for line in plan if "Aggregate [" in line and "Order_ID" in line.split("], [")[0]]
    assert by_order and not any("Net_Revenue_USD" in line for line in by_order)


def test_the_cleaned_sheet_is_read_as_a_plan(spark, tmp_path):
    """One reader of the cleaned rows needs no written table of judged ones; where there is one, it is read."""
    w = Workbench(spark, "", str(tmp_path))
    w.sheet, w.rules = sheet(spark), cleaning.CleaningRules()
    planned = sorted(map(repr, w.cleaned_read().collect()))
    assert "judged" not in w.__dict__ and not (tmp_path / "sheet" / "judged").exists()
    assert planned and planned == sorted(map(repr, w.cleaned.collect()))
    assert planned == sorted(map(repr, w.cleaned_read().collect())) and "judged" in w.__dict__
