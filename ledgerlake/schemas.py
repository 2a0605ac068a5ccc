"""Source tables, their types, keys and vocabularies."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SOURCE_ROW = "_source_row"
LINEAGE = ("_load_id", "_source_file", SOURCE_ROW, "_ingested_at")

_KINDS = {
    "str": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = False
    unique: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return _KINDS[self.kind]


def _table(*specs: str) -> tuple[Field, ...]:
    """Each spec is ``name kind [null] [key]``."""
    built = []
    for spec in specs:
        name, kind, *flags = spec.split()
        built.append(Field(name, kind, nullable="null" in flags, unique="key" in flags))
    return tuple(built)


# Column names, types, optional columns and keys of the seven source tables.
TABLES: dict[str, tuple[Field, ...]] = {
    "customers": _table("customer_id str key", "signup_date date", "home_city str", "segment str"),
    "products": _table(
        "product_id str key", "name str", "category str", "base_price float", "base_cost float"
    ),
    "orders": _table(
        "order_id str key",
        "customer_id str",
        "order_timestamp timestamp",
        "channel str",
        "payment_method str",
        "promotion_id str null",
    ),
    "order_items": _table(
        "line_id str key",
        "order_id str",
        "product_id str",
        "quantity int",
        "unit_price float",
        "unit_cost float",
        "discount_rate float",
    ),
    "returns": _table(
        "return_id str key", "line_id str", "return_date date", "returned_quantity int", "reason str"
    ),
    "promotions": _table(
        "promotion_id str key",
        "promotion_type str",
        "start_date date",
        "end_date date",
        "discount_policy float",
    ),
    "calendar_events": _table(
        "date date key", "holiday str null", "campaign str null", "seasonal_event str"
    ),
}
SOURCE_TABLES = tuple(TABLES)


def spark_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.spark_type) for f in TABLES[table]])


def with_source_row(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SOURCE_ROW, T.LongType())])


@dataclass(frozen=True)
class Vocabulary:
    """Allowed values. The defaults are fixed values of the retail source contract."""

    segments: tuple[str, ...] = ("Consumer", "Corporate", "Small Business")
    channels: tuple[str, ...] = ("Online", "Store", "Marketplace")
    payment_methods: tuple[str, ...] = ("Credit Card", "Debit Card", "Digital Wallet")
    return_reasons: tuple[str, ...] = ("Damaged", "Changed mind", "Wrong item")
    seasons: tuple[str, ...] = ("Winter", "Spring", "Summer", "Autumn")
    promotion_types: tuple[str, ...] = ("holiday",)


@dataclass(frozen=True)
class SourceTables:
    """One batch: seven tables, each with its 0-based ``_source_row``, and the batch dates."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    returns: DataFrame
    promotions: DataFrame
    calendar_events: DataFrame
    start_date: date
    end_date: date
    vocabulary: Vocabulary = field(default_factory=Vocabulary)

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, table)

    def replace(self, **changes) -> SourceTables:
        return SourceTables(**{f.name: changes.get(f.name, getattr(self, f.name)) for f in fields(self)})


# Raw order-line sheet. Quantity and Order_Date hold mixed content, so they are read as text.
FLAT_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("Order_Line_ID", T.StringType()),
            ("Order_ID", T.StringType()),
            ("Order_Date", T.StringType()),
            ("Customer_ID", T.StringType()),
            ("Product", T.StringType()),
            ("Category", T.StringType()),
            ("City", T.StringType()),
            ("Quantity", T.StringType()),
            ("Unit_Price_USD", T.DoubleType()),
            ("Discount_Rate", T.DoubleType()),
            ("Payment_Method", T.StringType()),
        )
    ]
)
FLAT_COLUMNS = tuple(FLAT_SCHEMA.fieldNames())

# Approved category of each product and spelling of each payment method.
PRODUCT_CATEGORIES = {
    "Laptop": "Computers",
    "Monitor": "Computers",
    "Keyboard": "Accessories",
    "Wireless Mouse": "Accessories",
    "USB-C Hub": "Accessories",
    "Webcam": "Accessories",
    "Headphones": "Audio",
    "Bluetooth Speaker": "Audio",
    "External SSD": "Storage",
    "USB Flash Drive": "Storage",
    "Office Chair": "Furniture",
    "Desk Lamp": "Furniture",
}
PAYMENT_METHODS = {
    "credit card": "Credit Card",
    "debit card": "Debit Card",
    "paypal": "PayPal",
    "bank transfer": "Bank Transfer",
}
