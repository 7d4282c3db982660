"""Runs a query and its SQL on the same tables and compares names, types and values."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def rows_of(arrow):
    names = sorted(arrow.column_names)
    columns = [[plain(v) for v in arrow.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


def differences(spark_df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours, theirs = spark_df.toArrow(), db.execute(sql).to_arrow_table()
    names, left = rows_of(ours)
    other_names, right = rows_of(theirs)
    if names != other_names:
        return f"columns {names} / {other_names}"
    types = [(n, str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in names]
    wrong = [t for t in types if t[1].replace("large_", "") != t[2].replace("large_", "") and not {t[1], t[2]} <= {"string", "string_view"}]
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{names}\n  spark {a}\n  sql   {b}"
    return f"types {wrong}" if wrong else None
