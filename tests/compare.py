"""Compare a Spark result with the oracle's, column by column and value by value."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _value(v):
    if v is None or v != v:
        return "NULL"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, float):
        return f"f:{v + 0.0!r}"
    if isinstance(v, datetime.datetime):
        return f"t:{v.replace(tzinfo=None).isoformat()}"
    if isinstance(v, int):
        return f"i:{v}"
    return f"{type(v).__name__}:{v}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def oracle_rows(sql: str, sf_dir: str):
    con = connection(sf_dir)
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def oracle_types(sql: str, sf_dir: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection(sf_dir).execute("DESCRIBE " + sql).fetchall()}


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, sql: str, sf_dir: str) -> str | None:
    """None when both agree, otherwise the first difference."""
    types = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    if types != oracle_types(sql, sf_dir):
        return f"columns differ: {types} vs {oracle_types(sql, sf_dir)}"
    names, rows = oracle_rows(sql, sf_dir)
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(names)}\n  spark  {str(a)[:1000]}\n  oracle {str(b)[:1000]}"
    return None
