"""Run a registered query and its SQL twin and compare them, columns by name and rows in any order."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from catalog.adapter import BASE_SCHEMAS
from catalog.oracle import oracle_query
from catalog.queries import QUERIES, runnable


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in BASE_SCHEMAS:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark: SparkSession, db, folder: str, name: str) -> tuple[int, list[str]]:
    """Row count and what differs (nothing, if the two agree exactly)."""
    df = runnable(QUERIES[name])(spark, folder)
    table = df.toArrow()
    ours = _rows(df.columns, zip(*[c.to_pylist() for c in table.columns]))
    result = db.execute(oracle_query(name))
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return table.num_rows, [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    if not extra and not missing:
        return table.num_rows, []
    key = lambda item: tuple(str(v) for v in item[0])
    shown = [f"{kind} {dict(zip(order, row))} x{n}" for kind, rows in (("only spark", extra), ("only duckdb", missing))
             for row, n in sorted(rows, key=key)[:2]]
    return table.num_rows, [f"{len(extra)} rows only in spark, {len(missing)} only in duckdb", *shown]
