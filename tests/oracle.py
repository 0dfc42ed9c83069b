"""Runs queries and their SQL over one folder of tables and compares rows, column by column in order of name."""

import math
import sys
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return str(v)


def compare(spark, name, query, sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = [tuple(plain(r[i]) for i in order) for r in want.fetchall()]
    df = query(spark, folder)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got = [tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect()]
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    key = lambda r: [(v is None, str(type(v)), v if not isinstance(v, float) else round(v, 3)) for v in r]
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        for a, b in zip(g, w):
            if a != b and not (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)):
                return f"{g} and {w}"
    return None
