"""Compares a query with its SQL, as bags of rows."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in df.schema.fields}
    if types != expected_types:
        return f"schema {types} != {expected_types}"
    got = _bag(df.columns, map(tuple, df.collect()))
    want = _bag(result.columns, result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())};"
        f" extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}"
    )
