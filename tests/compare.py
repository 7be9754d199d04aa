"""Run named queries on Spark and their SQL on DuckDB, and compare whole results."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    """Floats as their exact text, so that -0.0 and NaN count too."""
    return repr(value) if isinstance(value, float) else value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(spark_df, con, sql: str) -> str | None:
    """None if columns, row count and every value agree exactly, else what differs."""
    relation = con.sql(sql)
    columns = sorted(spark_df.columns)
    if columns != sorted(relation.columns):
        return f"columns {columns} != {sorted(relation.columns)}"
    order = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in relation.fetchall()), key=_key)
    rows = spark_df.select(*[f"`{c}`" for c in columns]).collect()
    ours = sorted((tuple(_plain(v) for v in r) for r in rows), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
            return f"first difference {bad} in {a}"
    types = dict(spark_df.dtypes)
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    off = {c: (types[c], sql_types[c]) for c in columns if sql_types[c] != same.get(types[c], sql_types[c])}
    return f"TYPES {off}" if off else None
