"""Runs registered queries next to their SQL and compares every row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{Path(sf_dir) / t}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def _normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=_key)


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """Empty when names, types (as Python sees them) and all values are equal."""
    spark_names, spark_rows = _normal([tuple(r) for r in df.collect()], df.columns)
    names, rows = _normal(*reversed(oracle_rows(sql, sf_dir)))
    if spark_names != names:
        return [f"columns {spark_names} != {names}"]
    if len(spark_rows) != len(rows):
        return [f"{len(spark_rows)} rows != {len(rows)}"]
    return [f"{a} != {b}" for a, b in zip(spark_rows, rows) if a != b or [type(x) for x in a] != [type(x) for x in b]]
