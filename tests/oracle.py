"""Compare a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql) -> list[str]:
    """Empty when column names, types and rows agree."""
    rel = con.sql(sql)
    names, types = list(rel.columns), [str(t) for t in rel.types]
    want = rel.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    out = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    spark_types = dict(spark_df.dtypes)
    for name, kind in zip(names, types):
        if _TYPES.get(spark_types[name], spark_types[name]) != kind:
            out.append(f"type of {name}: {spark_types[name]} != {kind}")
    left, right = _rows(spark_df.columns, got), _rows(names, want)
    if len(left) != len(right):
        out.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        out.append(f"values: only spark {only_left}; only sql {only_right}")
    return out
