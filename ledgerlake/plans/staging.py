"""Typed staging: one projection per bronze table, same rows, no filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import MONEY, RATE, blank_to_null
from ledgerlake.schemas import LINEAGE


def _key(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def _text(name: str, alias: str | None = None) -> Column:
    return blank_to_null(F.col(name)).alias(alias or name)


def _as(name: str, kind: str, alias: str | None = None) -> Column:
    return F.col(name).cast(kind).alias(alias or name)


def _stage(bronze: DataFrame, *columns: Column) -> DataFrame:
    return bronze.select(*columns, *LINEAGE)


def stg_customers(bronze: DataFrame) -> DataFrame:
    return _stage(bronze, _key("customer_id"), _as("signup_date", "date"), _text("home_city"), _text("segment"))


def stg_products(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze,
        _key("product_id"),
        _text("name", "product_name"),
        _text("category"),
        _as("base_price", MONEY),
        _as("base_cost", MONEY),
    )


def stg_orders(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze,
        _key("order_id"),
        _key("customer_id"),
        _as("order_timestamp", "timestamp_ntz"),
        _text("channel"),
        _text("payment_method"),
        _text("promotion_id"),
    )


def stg_order_items(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze,
        _key("line_id"),
        _key("order_id"),
        _key("product_id"),
        _as("quantity", "bigint"),
        _as("unit_price", MONEY),
        _as("unit_cost", MONEY),
        _as("discount_rate", RATE),
    )


def stg_returns(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze,
        _key("return_id"),
        _key("line_id"),
        _as("return_date", "date"),
        _as("returned_quantity", "bigint"),
        _text("reason"),
    )


def stg_promotions(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze,
        _key("promotion_id"),
        _text("promotion_type"),
        _as("start_date", "date"),
        _as("end_date", "date"),
        _as("discount_policy", RATE),
    )


def stg_calendar_events(bronze: DataFrame) -> DataFrame:
    return _stage(
        bronze, _as("date", "date", "event_date"), _text("holiday"), _text("campaign"), _text("seasonal_event")
    )


STAGING = {
    "customers": stg_customers,
    "products": stg_products,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "returns": stg_returns,
    "promotions": stg_promotions,
    "calendar_events": stg_calendar_events,
}
