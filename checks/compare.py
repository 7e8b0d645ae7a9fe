"""Runs queries on both engines and compares rows, names and types."""

from __future__ import annotations

import decimal
import glob
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import CATALOG

SPARK_KIND = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def ordered(rows, names, order):
    picked = [tuple(plain(row[names.index(name)]) for name in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def compare(spark: SparkSession, sf_dir: str, name: str, con=None) -> dict:
    """Outcome of one query: rows, seconds of each engine and the first difference, if any."""
    query = CATALOG[name]
    started = time.time()
    df = query.run(spark, sf_dir)
    mine = [tuple(row) for row in df.collect()]
    out = {"name": name, "rows": len(mine), "spark_s": round(time.time() - started, 2), "problem": None}
    if query.sql is None:
        return out
    con = con or connect(sf_dir)
    started = time.time()
    result = con.execute(query.sql)
    theirs = result.fetchall()
    out["duckdb_s"] = round(time.time() - started, 2)
    kinds = {d[0]: str(d[1]) for d in result.description}
    names = sorted(df.columns)
    if names != sorted(kinds):
        out["problem"] = f"columns {sorted(set(names) ^ set(kinds))}"
        return out
    for column, kind in df.dtypes:
        if SPARK_KIND.get(kind, kind) != kinds[column]:
            out["problem"] = f"type of {column}: {kind} and {kinds[column]}"
            return out
    if len(mine) != len(theirs):
        out["problem"] = f"{len(mine)} and {len(theirs)} rows"
        return out
    left, right = ordered(mine, df.columns, names), ordered(theirs, list(kinds), names)
    for a, b in zip(left, right, strict=True):
        if a != b:
            differing = {n: (x, y) for n, x, y in zip(names, a, b, strict=True) if x != y}
            out["problem"] = f"values {differing}"
            return out
    return out
