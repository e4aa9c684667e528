"""Run a query and its SQL text and compare the two results as row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def compare(query, sql, spark, con, folder) -> tuple[bool, str]:
    df = query(spark, folder)
    names = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    cursor = con.execute(sql)
    theirs_names = [d[0] for d in cursor.description]
    if sorted(theirs_names) != names:
        return False, f"columns {names} vs {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())
    if ours == theirs:
        return True, f"{sum(ours.values())} rows"
    left, right = ours - theirs, theirs - ours
    return False, (
        f"{names}: {sum(ours.values())} vs {sum(theirs.values())} rows; only ours {sum(left.values())} "
        f"{list(left)[:3]}; only theirs {sum(right.values())} {list(right)[:3]}"
    )
