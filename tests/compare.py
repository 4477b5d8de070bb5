"""Run queries and their expected results side by side."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

DATA = os.environ.get("TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=repr)


def expected(db, sql: str):
    relation = db.sql(sql)
    types = dict(zip(relation.columns, [KINDS.get(str(t), str(t)) for t in relation.types]))
    names = sorted(types)
    quoted = ", ".join(f'"{n}"' for n in names)
    return types, sorted_rows(db.execute(f"SELECT {quoted} FROM ({sql})").fetchall())


def actual(df):
    types = dict(df.dtypes)
    return types, sorted_rows(df.select(*sorted(types)).collect())
