from datetime import date, datetime

import pytest
from conftest import END, edit, make_batch
from pyspark.sql import functions as F

from ledgerlake.operators.contracts import find_all, validate_sources
from ledgerlake.operators.fingerprint import source_fingerprint
from ledgerlake.schemas import SOURCE_TABLES


def found(batch):
    return {
        (r["source_table"], r["source_row"], r["check_name"], r["column_name"], r["failure_case"])
        for r in find_all(batch, "load").collect()
    }


def rules(batch):
    return {(table, row, check) for table, row, check, _, _ in found(batch)}


def test_clean_batch_has_no_findings(spark, data):
    result = validate_sources(make_batch(spark, data), "load")
    assert result.findings.count() == 0
    summary = {r["source_table"]: r for r in result.summary.collect()}
    assert set(summary) == set(SOURCE_TABLES)
    assert all(r["invalid_rows"] == 0 and r["failure_count"] == 0 for r in summary.values())
    assert summary["order_items"]["valid_rows"] == 10
    assert result.accepted["returns"].count() == 3


@pytest.mark.parametrize(
    ("table", "index", "changes", "check", "column", "case"),
    [
        ("orders", 0, {"payment_method": None}, "not_nullable", "payment_method", None),
        ("customers", 0, {"home_city": None}, "not_nullable", "home_city", None),
        ("customers", 1, {"segment": "Pirate"}, "segment_allowed", "segment", "Pirate"),
        ("customers", 1, {"signup_date": date(2025, 4, 3)}, "signup_date_on_or_before_batch_end", "signup_date", "2025-04-03"),
        ("products", 0, {"base_cost": 0.0}, "base_cost_positive", "base_cost", "0.0"),
        ("products", 2, {"base_cost": 26.0}, "base_cost_lte_price", "base_cost,base_price", "base_cost=26.0, base_price=25.5"),
        ("orders", 5, {"order_timestamp": datetime(2025, 4, 3)}, "order_timestamp_in_range", "order_timestamp", "2025-04-03 00:00:00"),
        ("orders", 5, {"channel": "Phone"}, "channel_allowed", "channel", "Phone"),
        ("orders", 5, {"payment_method": "Cash"}, "payment_method_allowed", "payment_method", "Cash"),
        ("orders", 5, {"customer_id": "C9"}, "customer_id_foreign_key", "customer_id", "C9"),
        ("orders", 5, {"promotion_id": "PROMO-9"}, "promotion_id_foreign_key", "promotion_id", "PROMO-9"),
        ("order_items", 0, {"quantity": 0}, "quantity_positive", "quantity", "0"),
        ("order_items", 0, {"unit_cost": 0.0}, "unit_cost_positive", "unit_cost", "0.0"),
        ("order_items", 0, {"discount_rate": 1.5}, "discount_rate_between_zero_and_one", "discount_rate", "1.5"),
        ("order_items", 9, {"order_id": "MISSING-ORDER"}, "order_id_foreign_key", "order_id", "MISSING-ORDER"),
        ("order_items", 9, {"product_id": "P9"}, "product_id_foreign_key", "product_id", "P9"),
        ("returns", 0, {"returned_quantity": 0}, "returned_quantity_positive", "returned_quantity", "0"),
        ("returns", 0, {"reason": "Bored"}, "return_reason_allowed", "reason", "Bored"),
        ("returns", 0, {"returned_quantity": 4}, "returned_quantity_lte_ordered", "returned_quantity,line_id", "returned_quantity=4, line_id='L02'"),
        ("returns", 0, {"return_date": date(2025, 1, 1)}, "return_date_on_or_after_order", "return_date,line_id", "return_date=2025-01-01, line_id='L02'"),
        ("returns", 0, {"return_date": date(2025, 4, 3)}, "return_date_on_or_before_batch_end", "return_date", "2025-04-03"),
        ("promotions", 0, {"start_date": date(2024, 12, 31)}, "promotion_start_date_in_range", "start_date", "2024-12-31"),
        ("promotions", 0, {"end_date": date(2025, 4, 3)}, "promotion_end_date_in_range", "end_date", "2025-04-03"),
        ("promotions", 0, {"end_date": date(2025, 1, 4)}, "promotion_start_lte_end", "start_date,end_date", "start_date=2025-01-05, end_date=2025-01-04"),
        ("promotions", 0, {"discount_policy": 1.1}, "discount_policy_between_zero_and_one", "discount_policy", "1.1"),
        ("calendar_events", 5, {"date": date(2026, 1, 1)}, "calendar_date_in_range", "date", "2026-01-01"),
        ("calendar_events", 5, {"seasonal_event": "Monsoon"}, "season_allowed", "seasonal_event", "Monsoon"),
    ],
)
def test_one_broken_rule_gives_one_finding(spark, data, table, index, changes, check, column, case):
    edit(data, table, index, **changes)
    batch = make_batch(spark, data)
    assert found(batch) == {(table, index, check, column, case)}


def test_every_key_copy_is_flagged(spark, data):
    data["customers"].append(data["customers"][0])
    batch = make_batch(spark, data)
    assert rules(batch) == {("customers", 0, "field_uniqueness"), ("customers", 3, "field_uniqueness")}
    summary = {r["source_table"]: r for r in validate_sources(batch, "load").summary.collect()}
    assert (summary["customers"]["total_rows"], summary["customers"]["invalid_rows"]) == (4, 2)


def test_null_keys_are_missing_not_repeated(spark, data):
    edit(data, "customers", 1, customer_id=None)
    edit(data, "customers", 2, customer_id=None)
    assert {check for _, _, check in rules(make_batch(spark, data))} == {"not_nullable", "customer_id_foreign_key"}


def test_pair_rules_skip_rows_with_missing_values(spark, data):
    edit(data, "order_items", 9, unit_cost=900.0, product_id=None)
    assert rules(make_batch(spark, data)) == {("order_items", 9, "not_nullable")}


def test_return_of_unknown_line_fails_both_lookups(spark, data):
    edit(data, "returns", 0, line_id="L99")
    assert rules(make_batch(spark, data)) == {
        ("returns", 0, "line_id_foreign_key"),
        ("returns", 0, "returned_quantity_lte_ordered"),
        ("returns", 0, "return_date_on_or_after_order"),
    }


def test_lookup_rules_are_skipped_when_the_parent_key_repeats(spark, data):
    edit(data, "returns", 0, returned_quantity=99, return_date=date(2025, 1, 1))
    data["orders"].append(data["orders"][5])
    assert rules(make_batch(spark, data)) == {
        ("orders", 5, "field_uniqueness"),
        ("orders", 6, "field_uniqueness"),
        ("returns", 0, "returned_quantity_lte_ordered"),
    }
    data["order_items"].append(data["order_items"][9])
    assert {r for r in rules(make_batch(spark, data)) if r[0] == "returns"} == set()


def test_foreign_keys_accept_invalid_parents(spark, data):
    edit(data, "orders", 0, channel="Phone")
    assert rules(make_batch(spark, data)) == {("orders", 0, "channel_allowed")}


def test_empty_returns_are_valid(spark, data):
    data["returns"] = []
    result = validate_sources(make_batch(spark, data), "load")
    assert result.findings.count() == 0
    row = result.summary.where("source_table = 'returns'").first()
    assert (row["total_rows"], row["invalid_rows"]) == (0, 0)


def test_missing_parent_column_does_not_cascade(spark, data):
    batch = make_batch(spark, data)
    batch = batch.replace(orders=batch.orders.drop("order_id"))
    assert found(batch) == {("orders", None, "column_in_dataframe", "order_id", "order_id")}
    result = validate_sources(batch, "load")
    row = result.summary.where("source_table = 'orders'").first()
    assert (row["valid_rows"], row["invalid_rows"]) == (0, 6)
    assert result.accepted["orders"].count() == 0


def test_unexpected_column(spark, data):
    batch = make_batch(spark, data)
    batch = batch.replace(products=batch.products.withColumn("colour", F.lit("red")))
    assert found(batch) == {("products", None, "column_in_schema", "colour", "colour")}


def test_wrong_parent_type_is_reported(spark, data):
    batch = make_batch(spark, data)
    batch = batch.replace(orders=batch.orders.withColumn("order_timestamp", F.lit("never")))
    checks = {(t, c) for t, _, c in rules(batch)}
    assert ("orders", "dtype('datetime64[ns]')") in checks
    assert not {c for t, c in checks if t == "returns"}
    batch = batch.replace(products=batch.products.withColumn("base_price", F.lit("x")))
    assert ("products", None, "dtype('float64')") in rules(batch)


def test_text_in_place_of_dates_fails_row_by_row(spark, data):
    batch = make_batch(spark, data)
    batch = batch.replace(customers=batch.customers.withColumn("signup_date", F.col("signup_date").cast("string")))
    assert {c for _, _, c in rules(batch)} == {"date_type", "signup_date_on_or_before_batch_end"}
    assert {r for _, r, _ in rules(batch)} == {0, 1, 2}


def test_several_findings_in_one_run(spark, data):
    edit(data, "products", 0, base_price=-1.0)
    edit(data, "order_items", 0, quantity=0, discount_rate=2.0)
    edit(data, "order_items", 1, unit_price=0.0)
    edit(data, "orders", 1, order_timestamp=datetime(END.year, 12, 1))
    assert {
        ("products", 0, "base_price_positive"),
        ("products", 0, "base_cost_lte_price"),
        ("order_items", 0, "quantity_positive"),
        ("order_items", 1, "unit_price_positive"),
        ("order_items", 1, "unit_cost_lte_unit_price"),
        ("order_items", 0, "discount_rate_between_zero_and_one"),
        ("orders", 1, "order_timestamp_in_range"),
    } == rules(make_batch(spark, data))


def test_fingerprint_follows_content_position_and_structure(spark, data):
    batch = make_batch(spark, data)
    first = source_fingerprint(batch)
    assert source_fingerprint(batch.replace(order_items=batch.order_items.repartition(3))) == first
    edit(data, "customers", 0, home_city="Dallas")
    assert source_fingerprint(make_batch(spark, data)) != first
    edit(data, "customers", 0, home_city="Austin")
    data["products"][0], data["products"][1] = data["products"][1], data["products"][0]
    assert source_fingerprint(make_batch(spark, data)) != first
    renamed = batch.replace(promotions=batch.promotions.withColumnRenamed("promotion_type", "kind"))
    assert source_fingerprint(renamed) != first


def test_fingerprint_sees_which_column_is_null(spark, data):
    edit(data, "calendar_events", 3, holiday="X", campaign=None)
    first = source_fingerprint(make_batch(spark, data))
    edit(data, "calendar_events", 3, holiday=None, campaign="X")
    assert source_fingerprint(make_batch(spark, data)) != first
