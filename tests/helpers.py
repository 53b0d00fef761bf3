"""Result comparison shared by the tests (same rules as tools/oracle_check.py)."""

import math

import duckdb

from rtmart.sources.tables import TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _sortkey(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0)
                 for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=_sortkey)


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(norm(r[i]) for i in idx) for r in res.fetchall()]
    return cols, sorted(rows, key=_sortkey)
