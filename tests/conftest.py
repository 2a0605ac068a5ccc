import copy
import os
import sys
from datetime import date, datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.schemas import SOURCE_ROW, SOURCE_TABLES, SourceTables, spark_schema, with_source_row  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

START, END = date(2025, 1, 1), date(2025, 4, 2)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _ts(month, day, hour=10):
    return datetime(2025, month, day, hour)


CLEAN = {
    "customers": [
        ("C1", date(2024, 1, 5), "Austin", "Consumer"),
        ("C2", date(2024, 3, 9), "Boston", "Corporate"),
        ("C3", date(2024, 6, 1), "Austin", "Small Business"),
    ],
    "products": [
        ("P1", "Laptop", "Computers", 1000.0, 700.0),
        ("P2", "Monitor", "Computers", 200.0, 120.0),
        ("P3", "Mouse", "Accessories", 25.5, 10.25),
        ("P4", "Hub", "Accessories", 40.0, 20.0),
    ],
    "orders": [
        ("O1", "C1", _ts(1, 2), "Online", "Credit Card", None),
        ("O2", "C1", _ts(1, 8), "Store", "Debit Card", None),
        ("O3", "C2", _ts(1, 9), "Marketplace", "Digital Wallet", "PROMO-1"),
        ("O4", "C2", _ts(2, 3), "Online", "Credit Card", None),
        ("O5", "C1", _ts(2, 4), "Online", "Credit Card", None),
        ("O6", "C2", _ts(2, 5), "Store", "Debit Card", None),
    ],
    "order_items": [
        ("L01", "O1", "P1", 1, 999.99, 700.0, 0.0),
        ("L02", "O1", "P3", 3, 25.55, 10.25, 0.05),
        ("L03", "O2", "P2", 2, 199.95, 120.0, 0.0),
        ("L04", "O2", "P2", 1, 199.95, 120.0, 0.1),
        ("L05", "O3", "P3", 5, 25.55, 10.25, 0.1),
        ("L06", "O3", "P4", 2, 39.9, 20.0, 0.1),
        ("L07", "O4", "P1", 1, 1000.0, 700.0, 0.0),
        ("L08", "O5", "P4", 4, 40.0, 20.0, 0.0),
        ("L09", "O6", "P3", 2, 25.5, 10.25, 0.0),
        ("L10", "O6", "P2", 1, 200.0, 120.0, 0.0),
    ],
    "returns": [
        ("R1", "L02", date(2025, 1, 4), 1, "Damaged"),
        ("R2", "L06", date(2025, 1, 20), 2, "Wrong item"),
        ("R3", "L08", date(2025, 2, 11), 4, "Changed mind"),
    ],
    "promotions": [("PROMO-1", "holiday", date(2025, 1, 5), date(2025, 1, 31), 0.1)],
    "calendar_events": [
        (
            START + timedelta(days=i),
            "New Year" if i == 0 else None,
            "PROMO-1" if 4 <= i <= 30 else None,
            "Winter" if i < 59 else "Spring",
        )
        for i in range(92)
    ],
}


@pytest.fixture
def data():
    return copy.deepcopy(CLEAN)


def table_of(spark, rows, schema):
    """A literal table. Arrow input becomes a local relation, which plans and runs fastest."""
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), kind) for c, kind in zip(columns, to_arrow_schema(schema).types, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.fieldNames()), schema)


def make_batch(spark, rows, **frames):
    """A batch from literal rows; ``frames`` replace whole tables."""
    built = {}
    for table in SOURCE_TABLES:
        numbered = [(*row, i) for i, row in enumerate(rows[table])]
        built[table] = table_of(spark, numbered, with_source_row(spark_schema(table)))
    return SourceTables(**{**built, **frames}, start_date=START, end_date=END)


def edit(rows, table, index, **changes):
    names = spark_schema(table).fieldNames()
    row = list(rows[table][index])
    for name, value in changes.items():
        row[names.index(name)] = value
    rows[table][index] = tuple(row)


def as_dicts(df):
    return [row.asDict() for row in df.collect()]


__all__ = ["SOURCE_ROW", "as_dicts", "edit", "make_batch", "table_of"]
