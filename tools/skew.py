"""Write a copy of the input tables in which single keys own a third of the rows.

    python tools/skew.py <folder> <new folder>

One order owns a third of the lines, one part another third (with an overlap), and one customer
a third of the orders. Supplier keys are numbered through, so that line keys stay unique. Use with
``tools/compare.py`` to check results under skew.
"""

from __future__ import annotations

import os
import shutil
import sys

import duckdb

REWRITTEN = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 7 ELSE o_custkey END AS o_custkey) FROM t",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN (l_partkey * 31 + l_suppkey) % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN (l_partkey * 17 + l_linenumber) % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey,
        row_number() OVER () AS l_suppkey) FROM t""",
}


def main(source: str, target: str) -> None:
    os.makedirs(target)
    for name in os.listdir(source):
        table = name.removesuffix(".parquet")
        if table not in REWRITTEN:
            shutil.copy(f"{source}/{name}", f"{target}/{name}")
            continue
        con = duckdb.connect()
        con.execute(f"CREATE VIEW t AS SELECT * FROM read_parquet('{source}/{name}')")
        con.execute(f"COPY ({REWRITTEN[table]}) TO '{target}/{name}' (FORMAT parquet)")


if __name__ == "__main__":
    main(*sys.argv[1:])
