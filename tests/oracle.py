"""Runs a query and its SQL side by side and compares names, types, row counts and values."""

from __future__ import annotations

import math
import os
import time

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as from '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(table) -> tuple[list, list]:
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return list(zip(names, types)), sorted(zip(*columns)) if columns else []


def _plain(schema):
    return [(n, t.replace("[us]", "")) for n, t in schema]


def compare(spark, sf_dir: str, query, sql: str, con=None) -> dict:
    con = con or connect(sf_dir)
    started = time.time()
    got_schema, got = _rows(query(spark, sf_dir).toArrow())
    seconds = time.time() - started
    want_schema, want = _rows(con.sql(sql).to_arrow_table())
    diff = [(g, w) for g, w in zip(got, want) if g != w][:3] if got != want else []
    return {
        "ok": _plain(got_schema) == _plain(want_schema) and got == want and len(got) > 0,
        "rows": (len(got), len(want)),
        "schema": [] if _plain(got_schema) == _plain(want_schema) else (got_schema, want_schema),
        "diff": diff,
        "seconds": round(seconds, 2),
    }
