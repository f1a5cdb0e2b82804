"""Compare a Spark registry query with its DuckDB oracle (driver-style).

Columns are sorted by name; rows compared as multisets.  Floats are
compared exactly first; a tolerance pass only explains a mismatch.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "asDict"):
        return tuple(v)
    return v


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [cols[i] for i in order], rows, types


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    return [cols[i] for i in order], rows, types


_TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}


def compare(spark, con, name, query, sql, sf_dir):
    s_cols, s_rows, s_types = spark_rows(query(spark, sf_dir))
    d_cols, d_rows, d_types = duck_rows(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                        f"duck-only {sorted(set(d_cols) - set(s_cols))}")
        return problems, len(s_rows), len(d_rows)
    for c in s_cols:
        if _TYPE_MAP.get(s_types[c], s_types[c]) != d_types[c]:
            problems.append(f"type {c}: spark {s_types[c]} duck {d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark {len(s_rows)} duck {len(d_rows)}")
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        problems.append(f"values differ ({sum((cs - cd).values())} rows); cols {s_cols}\n"
                        f"   spark-only e.g. {only_s}\n   duck-only e.g. {only_d}")
    return problems, len(s_rows), len(d_rows)
