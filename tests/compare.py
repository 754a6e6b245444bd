"""Runs a registered query on Spark and its SQL on DuckDB and compares names, types and rows."""

from __future__ import annotations

from collections import Counter

import duckdb
import pyarrow as pa

TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(n).to_pylist() for n in names])) if table.num_rows else Counter()


def differences(query, sql: str, spark, folder: str) -> list[str]:
    """What differs, or an empty list."""
    got = query(spark, folder).toArrow()
    want = duck(folder).sql(sql).to_arrow_table()
    got_types = {f.name: _kind(f.type) for f in got.schema}
    want_types = {f.name: _kind(f.type) for f in want.schema}
    if got_types != want_types:
        return [f"types: {sorted(set(got_types.items()) ^ set(want_types.items()))}"]
    a, b = _rows(got), _rows(want)
    if a == b:
        return [] if a else ["both are empty"]
    return [f"rows: {got.num_rows} and {want.num_rows}", f"only Spark: {list((a - b).items())[:3]}",
            f"only SQL: {list((b - a).items())[:3]}"]
