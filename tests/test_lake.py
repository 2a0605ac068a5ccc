from datetime import date, datetime

import pytest
from conftest import as_dicts, edit, make_batch
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.operators.contracts import validate_sources
from ledgerlake.plans import conform, gold, marts
from ledgerlake.plans.lake import Lake, check_run
from ledgerlake.plans.staging import STAGING
from ledgerlake.schemas import SOURCE_TABLES


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def load(lake, batch, load_id):
    return lake.ingest(batch, validate_sources(batch, load_id), load_id)


def test_bootstrap_can_be_repeated(lake):
    lake.bootstrap()
    lake.bootstrap()
    assert lake.runs().count() == 0
    assert lake.failures().count() == 0
    assert all(lake.exists(lake.path(area)) for area in ("bronze", "silver", "gold", "audit"))


@pytest.mark.parametrize(
    "change",
    [
        {"status": "succeeded"},
        {"status": "failed", "completed_at": 1},
        {"status": "odd"},
        {"valid_row_count": 9, "invalid_row_count": 2},
        {"source_row_count": -1},
        {"completed_at": 1},
    ],
)
def test_audit_rows_must_be_consistent(change):
    run = {
        "status": "running",
        "completed_at": None,
        "error_summary": None,
        "source_row_count": 10,
        "valid_row_count": 8,
        "invalid_row_count": 2,
    }
    assert check_run(run) == run
    with pytest.raises(ValueError):
        check_run({**run, **change})


def test_load_keeps_values_and_adds_lineage(spark, data, lake):
    edit(data, "order_items", 3, quantity=0)
    batch = make_batch(spark, data)
    outcome = load(lake, batch, "load-a")
    assert (outcome.status, outcome.source_row_count, outcome.invalid_row_count, outcome.failure_count) == ("succeeded", 119, 1, 1)
    for table in SOURCE_TABLES:
        bronze = lake.bronze(table, "load-a")
        columns = [c for c in batch[table].columns if c != "_source_row"]
        assert bronze.select(*columns, "_source_row").exceptAll(batch[table].select(*columns, "_source_row")).count() == 0
        assert bronze.count() == batch[table].count()
        assert {r["_source_file"] for r in bronze.select("_source_file").distinct().collect()} == {f"{table}.csv"}
        assert bronze.where("_ingested_at is null or _load_id is null or _source_row is null").count() == 0
    (failure,) = as_dicts(lake.failures("load-a"))
    assert (failure["source_file"], failure["source_row"], failure["check_name"]) == ("order_items.csv", 3, "quantity_positive")
    (run,) = as_dicts(lake.runs())
    assert (run["status"], run["valid_row_count"], run["error_summary"]) == ("succeeded", 118, None)
    assert run["completed_at"] >= run["started_at"]


def test_same_content_is_loaded_once(spark, data, lake):
    batch = make_batch(spark, data)
    load(lake, batch, "load-a")
    again = load(lake, make_batch(spark, data), "load-b")
    assert again.status == "skipped"
    assert lake.runs().count() == 1
    assert lake.bronze("orders").count() == 6


def test_load_id_cannot_be_reused(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    edit(data, "customers", 0, home_city="Dallas")
    with pytest.raises(ValueError, match="already used"):
        load(lake, make_batch(spark, data), "load-a")


def test_stale_or_foreign_validation_writes_nothing(spark, data, lake):
    validation = validate_sources(make_batch(spark, data), "load-a")
    with pytest.raises(ValueError, match="another load id"):
        lake.ingest(make_batch(spark, data), validation, "load-b")
    edit(data, "customers", 0, home_city="Dallas")
    with pytest.raises(ValueError, match="changed"):
        lake.ingest(make_batch(spark, data), validation, "load-a")
    assert lake.run_states().count() == 0
    assert lake.bronze_schema("customers") is None


def test_failed_load_is_recorded_and_invisible(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    wrong = make_batch(spark, data)
    wrong = wrong.replace(returns=wrong.returns.withColumn("returned_quantity", F.lit("many")))
    with pytest.raises(ValueError, match="returned_quantity"):
        load(lake, wrong, "load-b")
    runs = {r["load_id"]: r for r in lake.runs().collect()}
    assert runs["load-a"]["status"] == "succeeded"
    assert runs["load-b"]["status"] == "failed"
    assert "returned_quantity" in runs["load-b"]["error_summary"]
    assert runs["load-b"]["valid_row_count"] == 0
    assert lake.current_load_id() == "load-a"
    assert lake.bronze("orders").count() == 6
    assert {r["load_id"] for r in lake.failures().collect()} <= {"load-a"}


def test_failed_first_load_does_not_fix_the_schema(spark, data, lake, monkeypatch):
    def fail(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(lake, "_write_failures", fail)
        with pytest.raises(OSError, match="disk full"):
            load(lake, make_batch(spark, data), "load-a")
    assert lake.bronze_schema("orders") is None
    with pytest.raises(ValueError, match="already used"):
        load(lake, make_batch(spark, data), "load-a")
    assert load(lake, make_batch(spark, data), "load-b").status == "succeeded"
    assert lake.bronze("orders").count() == 6


def test_empty_table_is_typed_and_takes_later_rows(spark, data, lake):
    kept, data["returns"] = data["returns"], []
    load(lake, make_batch(spark, data), "load-a")
    assert dict(lake.bronze("returns").dtypes)["return_date"] == "date"
    data["returns"] = kept
    load(lake, make_batch(spark, data), "load-b")
    assert lake.bronze("returns").count() == 3
    assert lake.bronze("orders").count() == 12


def test_missing_column_loads_as_null(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    edit(data, "customers", 0, home_city="Dallas")
    batch = make_batch(spark, data)
    load(lake, batch.replace(promotions=batch.promotions.drop("promotion_type")), "load-b")
    rows = lake.bronze("promotions", "load-b").collect()
    assert [r["promotion_type"] for r in rows] == [None]
    assert lake.conformed("promotions", "load-b", {}).count() == 0


def test_latest_succeeded_load_is_current(spark):
    runs = spark.createDataFrame(
        [
            ("a", datetime(2025, 1, 1), datetime(2025, 1, 2), "succeeded"),
            ("b", datetime(2025, 1, 1), datetime(2025, 1, 3), "succeeded"),
            ("c", datetime(2025, 1, 2), datetime(2025, 1, 3), "succeeded"),
            ("d", datetime(2025, 1, 2), datetime(2025, 1, 3), "succeeded"),
            ("e", datetime(2025, 1, 9), datetime(2025, 1, 9), "failed"),
        ],
        "load_id string, started_at timestamp_ntz, completed_at timestamp_ntz, status string",
    )
    assert [r["load_id"] for r in conform.current_load(runs).collect()] == ["d"]


STAGED_TYPES = {
    "customers": {"customer_id": "string", "signup_date": "date"},
    "products": {"product_name": "string", "base_price": "decimal(18,2)", "base_cost": "decimal(18,2)"},
    "orders": {"order_timestamp": "timestamp_ntz", "promotion_id": "string"},
    "order_items": {"quantity": "bigint", "unit_price": "decimal(18,2)", "unit_cost": "decimal(18,2)", "discount_rate": "decimal(9,4)"},
    "returns": {"return_date": "date", "returned_quantity": "bigint"},
    "promotions": {"start_date": "date", "discount_policy": "decimal(9,4)"},
    "calendar_events": {"event_date": "date"},
}


def test_staging_keeps_rows_and_fixes_types(spark, data, lake):
    edit(data, "customers", 0, customer_id=" C1 ", home_city="   ")
    load(lake, make_batch(spark, data), "load-a")
    for table in SOURCE_TABLES:
        staged = STAGING[table](lake.bronze(table))
        assert staged.count() == len(data[table])
        assert STAGED_TYPES[table].items() <= dict(staged.dtypes).items()
        assert staged.columns[-4:] == ["_load_id", "_source_file", "_source_row", "_ingested_at"]
    row = STAGING["customers"](lake.bronze("customers")).where("_source_row = 0").first()
    assert (row["customer_id"], row["home_city"]) == ("C1", None)


def layers(lake, load_id):
    silver = lake.build_silver(load_id)
    staged = {t: lake.staged(t, load_id) for t in conform.CONFORMED_TABLES}
    rejected = conform.int_rejected_records(staged, lake.failures(load_id), silver)
    return silver, rejected


def reasons(rejected):
    return {(r["source_table"], r["source_row"], r["rule_code"]) for r in rejected.collect()}


def balance(lake, load_id, silver, rejected):
    bronze = {t: lake.bronze(t, load_id) for t in conform.CONFORMED_TABLES}
    return {r["source_table"]: r for r in quality.layer_balance(bronze, silver, rejected).collect()}


def test_rejected_customer_takes_orders_lines_and_returns_along(spark, data, lake):
    edit(data, "customers", 0, segment="Pirate")
    load(lake, make_batch(spark, data), "load-a")
    silver, rejected = layers(lake, "load-a")
    assert reasons(rejected) == (
        {("customers", 0, "segment_allowed")}
        | {("orders", i, "customer_not_accepted") for i in (0, 1, 4)}
        | {("order_items", i, "order_not_accepted") for i in (0, 1, 2, 3, 7)}
        | {("returns", i, "order_item_not_accepted") for i in (0, 2)}
    )
    assert {t: df.count() for t, df in silver.items()} == {
        "customers": 2, "products": 4, "promotions": 1, "orders": 3, "order_items": 5, "returns": 1,
    }
    assert all(r["balanced"] for r in balance(lake, "load-a", silver, rejected).values())


def test_several_reasons_count_one_row(spark, data, lake):
    edit(data, "promotions", 0, discount_policy=2.0)
    edit(data, "products", 2, base_price=-1.0, base_cost=-2.0)
    edit(data, "products", 3, name=None)
    load(lake, make_batch(spark, data), "load-a")
    silver, rejected = layers(lake, "load-a")
    found = reasons(rejected)
    assert ("orders", 2, "promotion_not_accepted") in found
    assert {("order_items", 5, "order_not_accepted"), ("order_items", 5, "product_not_accepted")} <= found
    texts = {(r["source_table"], r["rule_code"]): r["reason"] for r in rejected.collect()}
    assert texts[("products", "not_nullable")] == "name failed not_nullable"
    assert texts[("orders", "promotion_not_accepted")] == "promotion parent was rejected during conformance"
    assert all(r["balanced"] for r in balance(lake, "load-a", silver, rejected).values())


def test_directly_rejected_rows_get_no_cascade_reason(spark, data, lake):
    edit(data, "customers", 0, segment="Pirate")
    edit(data, "orders", 0, channel="Phone")
    load(lake, make_batch(spark, data), "load-a")
    _, rejected = layers(lake, "load-a")
    assert {r for r in reasons(rejected) if r[:2] == ("orders", 0)} == {("orders", 0, "channel_allowed")}


def test_table_level_finding_rejects_the_table(spark, data, lake):
    batch = make_batch(spark, data)
    batch = batch.replace(products=batch.products.withColumn("colour", F.lit("red")))
    load(lake, batch, "load-a")
    silver, rejected = layers(lake, "load-a")
    assert silver["products"].count() == 0
    found = reasons(rejected)
    assert {r for r in found if r[0] == "products"} == {("products", i, "column_in_schema") for i in range(4)}
    assert {r for r in found if r[0] == "order_items"} == {("order_items", i, "product_not_accepted") for i in range(10)}
    assert all(r["balanced"] for r in balance(lake, "load-a", silver, rejected).values())


def test_parents_come_from_the_same_load(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    edit(data, "customers", 1, segment="Pirate")
    load(lake, make_batch(spark, data), "load-b")
    assert lake.current_load_id() == "load-b"
    silver, rejected = layers(lake, "load-b")
    assert {r["order_id"] for r in silver["orders"].collect()} == {"O1", "O2", "O5"}
    assert {r["_load_id"] for r in silver["order_items"].collect()} == {"load-b"}
    assert {r["load_id"] for r in rejected.collect()} == {"load-b"}
    older, _ = layers(lake, "load-a")
    assert older["orders"].count() == 6


def test_promotion_assignments(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    silver, _ = layers(lake, "load-a")
    rows = conform.int_promotion_assignments(silver["orders"], silver["promotions"]).collect()
    assert [(r["order_id"], r["promotion_id"]) for r in rows] == [("O3", "PROMO-1")]


def test_calendar_gap_is_closed(spark, data, lake):
    data["calendar_events"].pop(40)
    load(lake, make_batch(spark, data), "load-a")
    dates = gold.dim_date(lake.staged("calendar_events", "load-a"))
    rows = {r["full_date"]: r for r in dates.collect()}
    assert len(rows) == 92
    gap = rows[date(2025, 2, 10)]
    assert (gap["date_key"], gap["seasonal_event"], gap["day_of_week"], gap["day_name"]) == (20250210, None, 1, "Monday")
    first = rows[date(2025, 1, 1)]
    assert (first["month_name"], first["quarter_number"], first["holiday"]) == ("January", 1, "New Year")
    assert rows[date(2025, 1, 5)]["day_of_week"] == 0


def test_repeated_calendar_day_is_kept_twice(spark, data, lake):
    data["calendar_events"].append(data["calendar_events"][0])
    load(lake, make_batch(spark, data), "load-a")
    dates = gold.dim_date(lake.staged("calendar_events", "load-a"))
    assert dates.where("date_key = 20250101").count() == 2


@pytest.fixture
def star(spark, data, lake):
    load(lake, make_batch(spark, data), "load-a")
    silver = lake.build_silver("load-a")
    return silver, lake.build_gold("load-a", silver)


def test_written_gold_supports_marts(star):
    silver, built = star
    assert built["fact_sales"].count() == 10
    assert built["order_outcomes"].count() == 6
    one = marts.mart_executive(built["fact_sales"], built["fact_returns"]).collect()
    assert len(one) == 1
