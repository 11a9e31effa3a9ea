"""Run a query and its SQL and compare the rows, whatever their order."""

from __future__ import annotations

from collections import Counter

import duckdb

from catalog.registry import TABLES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


# Types both engines must agree on; widths of integers count.
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "\"NULL\"": "void",
}


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None if rows, names and types are equal, else a short report."""
    result = con.execute(sql)
    want_types = {d[0]: KINDS.get(str(d[1]), str(d[1]).lower()) for d in result.description}
    got_types = {f.name: f.dataType.simpleString().replace("_ntz", "") for f in df.schema}
    if got_types != want_types:
        return f"schema {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    got = _rows(df.columns, df.collect())
    want = _rows(list(want_types), result.fetchall())
    if not want:
        return "no rows to compare"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
        )
    return None
