"""Data tests on models: each yields a number of violations, zero when the test passes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, money
from ledgerlake.operators.bitmaps import maybe_in
from ledgerlake.operators.contracts import repeated_keys
from ledgerlake.schemas import Vocabulary
from ledgerlake.session import sized

Models = Mapping[str, DataFrame]
TOLERANCE = 0.01


@dataclass(frozen=True)
class ModelTest:
    """A declared test. ``column`` may be a SQL expression over the model's columns."""

    test: str
    model: str
    column: str
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""


def _keys(model: str, column: str, severity: str = "error") -> list[ModelTest]:
    return [ModelTest("unique", model, column, severity), ModelTest("not_null", model, column, severity)]


def _belongs(model: str, column: str, parent: str, parent_column: str, required: bool = True) -> list[ModelTest]:
    tests = [ModelTest("relationships", model, column, parent=parent, parent_column=parent_column)]
    return ([ModelTest("not_null", model, column)] if required else []) + tests


def declared_tests(vocabulary: Vocabulary) -> list[ModelTest]:
    """The tests declared on every layer. Repeated staging keys only warn: rejected rows are
    still visible there."""
    v = vocabulary
    accepted = lambda model, column, values: [ModelTest("accepted_values", model, column, values=values)]
    tests: list[ModelTest] = []
    # Models, columns and relationships under test.
    for model, key in (
        ("stg_customers", "customer_id"),
        ("stg_products", "product_id"),
        ("stg_orders", "order_id"),
        ("stg_order_items", "line_id"),
        ("stg_returns", "return_id"),
        ("stg_promotions", "promotion_id"),
        ("stg_calendar_events", "event_date"),
    ):
        tests += _keys(model, key, "warn")
    tests += accepted("stg_customers", "segment", v.segments)
    tests += accepted("stg_orders", "channel", v.channels)
    tests += accepted("stg_orders", "payment_method", v.payment_methods)
    tests += accepted("stg_returns", "reason", v.return_reasons)
    tests += accepted("stg_promotions", "promotion_type", v.promotion_types)
    tests += accepted("stg_calendar_events", "seasonal_event", v.seasons)
    for model, key in (
        ("int_customers", "customer_id"),
        ("int_products", "product_id"),
        ("int_promotions", "promotion_id"),
        ("int_orders", "order_id"),
        ("int_order_items", "line_id"),
        ("int_returns", "return_id"),
        ("int_promotion_assignments", "order_id"),
        ("dim_date", "date_key"),
        ("dim_date", "full_date"),
        ("dim_customer", "customer_id"),
        ("dim_product", "product_id"),
        ("dim_channel", "channel_key"),
        ("dim_geography", "geography_key"),
        ("dim_promotion", "promotion_id"),
        ("dim_payment_method", "payment_method_key"),
        ("fact_sales", "line_id"),
        ("fact_returns", "return_id"),
        ("mart_customer_360", "customer_id"),
        ("mart_cohort_base", "order_id"),
    ):
        tests += _keys(model, key)
    tests += _belongs("int_orders", "customer_id", "int_customers", "customer_id", required=False)
    tests += _belongs("int_orders", "promotion_id", "int_promotions", "promotion_id", required=False)
    tests += _belongs("int_order_items", "order_id", "int_orders", "order_id", required=False)
    tests += _belongs("int_order_items", "product_id", "int_products", "product_id", required=False)
    tests += _belongs("int_returns", "line_id", "int_order_items", "line_id", required=False)
    tests += _belongs("int_promotion_assignments", "promotion_id", "int_promotions", "promotion_id")
    for column in ("load_id", "source_table", "source_row", "source_file", "rule_code", "reason"):
        tests.append(ModelTest("not_null", "int_rejected_records", column))
    tests += accepted(
        "int_rejected_records",
        "source_table",
        ("customers", "products", "promotions", "orders", "order_items", "returns"),
    )
    tests += accepted("dim_channel", "channel_key", v.channels)
    tests += accepted("dim_payment_method", "payment_method_key", v.payment_methods)
    for fact in ("fact_sales", "fact_returns"):
        days = ("date_key",) if fact == "fact_sales" else ("return_date_key", "order_date_key")
        for day in days:
            tests += _belongs(fact, day, "dim_date", "date_key")
        tests += _belongs(fact, "customer_id", "dim_customer", "customer_id")
        tests += _belongs(fact, "product_id", "dim_product", "product_id")
        tests += _belongs(fact, "channel_key", "dim_channel", "channel_key")
        tests += _belongs(fact, "geography_key", "dim_geography", "geography_key")
        tests += _belongs(fact, "promotion_id", "dim_promotion", "promotion_id", required=False)
        tests += _belongs(fact, "payment_method_key", "dim_payment_method", "payment_method_key")
    tests += _belongs("fact_returns", "line_id", "fact_sales", "line_id")
    for model, columns in (
        ("mart_basket_base", ("order_id", "product_id")),
        ("mart_forecasting_base", ("week_start", "category")),
    ):
        tests += [ModelTest("not_null", model, column) for column in columns]
        tests.append(ModelTest("unique", model, " || '|' || ".join(columns)))
    return tests


def _labelled(df: DataFrame, test: ModelTest) -> DataFrame:
    return df.select(
        F.lit(test.test).alias("test_name"),
        F.lit(test.model).alias("model_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.severity).alias("severity"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def test_not_null(models: Models, tests: list[ModelTest]) -> DataFrame:
    """One scan per model, however many of its columns are tested."""
    own = [t for t in tests if t.test == "not_null"]
    parts = []
    for model in dict.fromkeys(t.model for t in own):
        group = [t for t in own if t.model == model]
        counts = models[model].agg(*[F.count_if(F.expr(t.column).isNull()).alias(f"c{i}") for i, t in enumerate(group)])
        rows = F.array(
            *[
                F.struct(
                    F.lit("not_null").alias("test_name"),
                    F.lit(model).alias("model_name"),
                    F.lit(t.column).alias("column_name"),
                    F.lit(t.severity).alias("severity"),
                    F.col(f"c{i}").alias("violations"),
                )
                for i, t in enumerate(group)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    return _union(parts)


def test_unique(models: Models, tests: list[ModelTest]) -> DataFrame:
    """Repeated non-NULL key values."""
    parts = []
    for t in (t for t in tests if t.test == "unique"):
        keyed = models[t.model].select(F.expr(t.column).alias("k")).where(F.col("k").isNotNull())
        parts.append(_labelled(repeated_keys(keyed, "k").agg(F.count("*").alias("violations")), t))
    return _union(parts)


def test_accepted_values(models: Models, tests: list[ModelTest]) -> DataFrame:
    """Distinct values outside the vocabulary."""
    parts = []
    for t in (t for t in tests if t.test == "accepted_values"):
        strange = models[t.model].where(~F.col(t.column).isin(*t.values)).select(t.column).distinct()
        parts.append(_labelled(strange.agg(F.count("*").alias("violations")), t))
    return _union(parts)


def test_relationships(models: Models, tests: list[ModelTest]) -> DataFrame:
    """Child rows without a parent; a NULL child passes. Child keys are counted before the
    join, so a popular key crosses the shuffle as one row per task."""
    parts = []
    own = [t for t in tests if t.test == "relationships"]
    keys = dict.fromkeys((t.parent, t.parent_column) for t in own)
    parents = {(model, column): sized(models[model].select(F.col(column).alias("k"))) for model, column in keys}
    for t in own:
        child = models[t.model].where(F.col(t.column).isNotNull()).groupBy(F.col(t.column).alias("k"))
        orphans = child.agg(F.count("*").alias("n")).join(parents[t.parent, t.parent_column], "k", "left_anti")
        parts.append(_labelled(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), t))
    return _union(parts)


# --- singular tests: each returns the offending rows ----------------------------------------------


def item_values_invalid(items: DataFrame) -> DataFrame:
    return items.where((F.col("quantity") <= 0) | (F.col("unit_cost") < 0) | (F.col("unit_price") <= 0))


def items_without_parents(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Lines whose order, the order's customer, or product is missing."""
    known = orders.select("order_id", "customer_id").join(sized(customers.select("customer_id")), "customer_id", "left_semi")
    whole = sized(known.select("order_id"))
    by_order = items.join(whole, "order_id", "left_anti")
    by_product = items.join(whole, "order_id", "left_semi").join(sized(products.select("product_id")), "product_id", "left_anti")
    return by_order.unionByName(by_product)


def returns_before_order(returns: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    ordered = orders.select("order_id", F.col("order_timestamp").cast("date").alias("_day"))
    return (
        returns.join(maybe_in(items.select("line_id", "order_id"), "line_id", returns), "line_id")
        .join(ordered, "order_id")
        .where(F.col("return_date") < F.col("_day"))
        .select(*returns.columns)
    )


def returns_above_ordered(returns: DataFrame, items: DataFrame) -> DataFrame:
    return (
        returns.join(maybe_in(items.select("line_id", "quantity"), "line_id", returns), "line_id")
        .where(F.col("returned_quantity") > F.col("quantity"))
        .select(*returns.columns)
    )


def broken_identities(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Fact rows whose amounts do not follow from quantity, price, cost and rate."""
    c = F.col
    sold = (
        (c("gross_sales") != money(c("ordered_quantity") * c("unit_price")))
        | (c("discount_amount") != money(c("gross_sales") * c("discount_rate")))
        | (c("net_sales") != c("gross_sales") - c("discount_amount"))
        | (c("cogs") != money(c("ordered_quantity") * c("unit_cost")))
        | (c("gross_profit") != c("net_sales") - c("cogs"))
    )
    refunded = money(c("returned_quantity") * c("unit_price") * (1 - c("discount_rate")))
    returned = (
        (c("returned_revenue") != refunded)
        | (c("reversed_cogs") != money(c("returned_quantity") * c("unit_cost")))
        | (c("profit_impact") != c("returned_revenue") - c("reversed_cogs"))
    )
    return (
        sales.where(sold)
        .select(F.lit("fact_sales").alias("model_name"), c("line_id").alias("record_id"))
        .unionByName(
            returns.where(returned).select(F.lit("fact_returns").alias("model_name"), c("return_id").alias("record_id"))
        )
    )


def layer_balance(bronze: Models, accepted: Models, rejected: DataFrame) -> DataFrame:
    """Per table: rows read, accepted and rejected. A row with several reasons counts once."""
    tables = tuple(accepted)

    def sizes(frames: Models, name: str) -> DataFrame:
        return _union(
            frames[t].agg(F.count("*").alias(name)).select(F.lit(t).alias("source_table"), name) for t in tables
        )

    fallen = rejected.groupBy("source_table").agg(F.countDistinct("source_row").alias("rejected_count"))
    return (
        sizes(bronze, "source_count")
        .join(sizes(accepted, "accepted_count"), "source_table")
        .join(fallen, "source_table", "left")
        .withColumn("rejected_count", F.coalesce("rejected_count", F.lit(0)))
        .withColumn("balanced", F.col("source_count") == F.col("accepted_count") + F.col("rejected_count"))
    )


# --- mart reconciliation ---------------------------------------------------------------------------

_SOLD = ("gross_sales", "discount_amount", "net_sales", "cogs", "gross_profit")
_BACK = ("returned_revenue", "reversed_cogs", "profit_impact")


def _far(left: Column, right: Column) -> Column:
    return F.abs(left - right) > TOLERANCE


def _fact_totals(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sums of the two facts, taken directly, as one row with ``t_`` columns."""
    sold = sales.agg(
        F.count("*").alias("t_sales_line_count"),
        F.countDistinct("order_id").alias("t_order_count"),
        *[F.sum(c).alias(f"t_{c}") for c in ("ordered_quantity", *_SOLD)],
    )
    buyers = sales.agg(F.countDistinct("customer_id").alias("t_customer_count"))
    back = returns.agg(
        F.count("*").alias("t_return_event_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"t_{c}") for c in ("returned_quantity", *_BACK)],
    )
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sold, buyers, back])
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def _expected(sales: DataFrame, returns: DataFrame, *keys: str) -> DataFrame:
    """Orders (or order products) not fully returned, derived from the facts alone.

    The customer is a grouping column: as an aggregate, text would force a sort of all lines. An
    order with two customers would show as two rows, and fail the comparison."""
    groups = [*keys, "customer_id"]
    sold = sales.groupBy(*groups).agg(
        F.sum("ordered_quantity").alias("e_ordered_quantity"), F.sum("net_sales").cast(MONEY).alias("e_net_sales")
    )
    back = returns.groupBy(*groups).agg(
        F.sum("returned_quantity").alias("e_returned_quantity"),
        F.sum("returned_revenue").cast(MONEY).alias("e_returned_revenue"),
    )
    filled = sold.join(back, groups, "left").withColumns(
        {
            "e_returned_quantity": F.coalesce("e_returned_quantity", F.lit(0)),
            "e_returned_revenue": F.coalesce(F.col("e_returned_revenue"), F.lit(0).cast(MONEY)),
        }
    )
    kept = filled.where(F.col("e_ordered_quantity") > F.col("e_returned_quantity"))
    return kept.withColumnRenamed("customer_id", "e_customer_id")


def _compare_rows(expected: DataFrame, actual: DataFrame, name: str, keys: list[str], left_over: str) -> DataFrame:
    c, e = F.col, lambda n: F.col(f"e_{n}")
    both = expected.join(actual, keys, "full")
    wrong = (
        e("customer_id").isNull()
        | c("customer_id").isNull()
        | (e("customer_id") != c("customer_id"))
        | (e("ordered_quantity") != c("ordered_quantity"))
        | (e("returned_quantity") != c("returned_quantity"))
        | (e("ordered_quantity") - e("returned_quantity") != c(left_over))
        | _far(e("net_sales"), c("net_sales"))
        | _far(e("returned_revenue"), c("returned_revenue"))
        | _far(e("net_sales") - e("returned_revenue"), c("return_adjusted_value"))
    )
    return both.agg(
        F.count_if(wrong).alias(f"{name}_measures"),
        (F.count("e_customer_id") != F.count("customer_id")).cast("bigint").alias(f"{name}_population"),
    )


def _summed(mart: DataFrame, prefix: str, columns) -> DataFrame:
    return mart.agg(*[F.sum(c).alias(f"{prefix}_{c}") for c in columns], F.count("*").alias(f"{prefix}_rows"))


def mart_reconciliation(sales: DataFrame, returns: DataFrame, mart: Models) -> DataFrame:
    """Seven named checks of the marts against the facts, with the number of violations.

    The facts are totalled once; all one-row results are stacked and compared in one row."""
    quantities = ("ordered_quantity", "returned_quantity")
    amounts = (*_SOLD, *_BACK)
    executive = ("sales_line_count", "order_count", "customer_count", "return_event_count", *quantities)
    orders, products = _expected(sales, returns, "order_id"), _expected(sales, returns, "order_id", "product_id")
    one_row_results = [
        _fact_totals(sales, returns),
        _summed(mart["mart_executive"], "x", (*executive, *amounts, "return_adjusted_revenue", "return_adjusted_profit")),
        _summed(
            mart["mart_customer_360"],
            "c",
            ("order_count", *quantities, *amounts, "return_adjusted_value", "return_adjusted_profit"),
        ),
        _summed(
            mart["mart_forecasting_base"],
            "f",
            ("order_count", *quantities, *amounts, "return_adjusted_revenue", "return_adjusted_profit"),
        ),
        _compare_rows(orders, mart["mart_cohort_base"], "cohort", ["order_id"], "retained_quantity"),
        _compare_rows(products, mart["mart_basket_base"], "basket", ["order_id", "product_id"], "remaining_quantity"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_results)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

    net = F.col("t_net_sales") - F.col("t_returned_revenue")
    profit = F.col("t_gross_profit") - F.col("t_profit_impact")

    def deviates(prefix: str, exact, value: str, *more: Column) -> Column:
        own = lambda c: F.col(f"{prefix}_{c}")
        tests = [own(c) != F.col(f"t_{c}") for c in exact] + [_far(own(c), F.col(f"t_{c}")) for c in amounts]
        tests += [_far(own(value), net), _far(own("return_adjusted_profit"), profit), *more]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)).cast("bigint")

    # An order with several categories counts once in each of them.
    too_few = F.col("f_order_count") < F.col("t_order_count")
    checks = {
        "executive_grain_or_totals": deviates("x", executive, "return_adjusted_revenue"),
        "executive_row_count": (F.col("x_rows") != 1).cast("bigint"),
        "customer_totals": deviates("c", ("order_count", *quantities), "return_adjusted_value"),
        "cohort_population": F.col("cohort_population"),
        "cohort_measures": F.col("cohort_measures"),
        "basket_measures": F.col("basket_measures"),
        "forecast_totals": deviates("f", quantities, "return_adjusted_revenue", too_few),
    }
    rows = [F.struct(F.lit(name).alias("check_name"), n.alias("violations")) for name, n in checks.items()]
    return row.select(F.inline(F.array(*rows)))
