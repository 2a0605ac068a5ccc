"""The damaged batch breaks every rule, so that a rule that never fires would show."""

import os

import pytest

from ledgerlake.plans.conform import CASCADES
from ledgerlake.queries import registered
from ledgerlake.workbench import Workbench

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="input tables are not here")


@pytest.mark.parametrize("name", ["contract_not_null", "contract_allowed", "contract_positive", "contract_range", "contract_cross_field"])
def test_every_rule_finds_something(spark, name):
    dates = ("calendar_date_in_range", "promotion_end_date_in_range")  # would change the calendar itself, or lie in its year
    counts = registered()[f"damaged_{name}"](spark, FOLDER).collect()
    kept_whole = {("promotions", "promotion_id"), ("promotions", "start_date"), ("promotions", "end_date"), ("promotions", "discount_policy"), ("calendar_events", "date")}
    for r in counts:
        if (r.source_table, r.column_name) not in kept_whole and r.check_name not in dates:
            assert r.failed_rows > 0, r
        assert r.failed_rows < r.checked_rows


def test_findings_and_cascades(spark):
    found = {(r.source_table, r.check_name) for r in registered()["damaged_contract_findings"](spark, FOLDER).collect()}
    wanted = {
        ("customers", "field_uniqueness"), ("products", "field_uniqueness"), ("returns", "field_uniqueness"), ("orders", "customer_id_foreign_key"),
        ("orders", "promotion_id_foreign_key"), ("order_items", "order_id_foreign_key"), ("order_items", "product_id_foreign_key"), ("returns", "line_id_foreign_key"),
        ("returns", "returned_quantity_lte_ordered"), ("returns", "return_date_on_or_after_order"),
    }
    assert wanted <= found
    rules = {(r.source_table, r.rule_code) for r in registered()["damaged_int_rejected_records"](spark, FOLDER).collect()}
    assert {(table, rule) for table, _, _, rule, _ in CASCADES} <= rules


def test_no_row_is_lost(spark):
    w = Workbench.of(spark, FOLDER)
    for name in ("customers", "orders", "order_items", "returns"):
        assert w.damaged.batch[name].count() == w.batch[name].count()
    layers = registered()["damaged_check_layers"](spark, FOLDER).collect()
    assert all(r.balanced and r.rejected_count > 0 for r in layers)
