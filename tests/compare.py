"""Spark rows against DuckDB rows, columns by name, rows in any order."""

from __future__ import annotations

import glob
import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        src = glob.glob(f"{path}/*.parquet") if os.path.isdir(path) else [path]
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({src!r})")
    return con


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str:
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    other = rows_of(rel.columns, rel.fetchall())
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(rel.columns)}"
    if mine == other:
        return ""
    odd = [x for x in mine if x not in set(other)][:2], [x for x in other if x not in set(mine)][:2]
    return f"{len(mine)} and {len(other)} rows, such as {odd}"
