"""Rows of a query and of its SQL in DuckDB, made comparable."""

import glob
import math
import os

SF = "/root/testdata/sf0.001"


def database(sf: str = SF):
    import duckdb

    c = duckdb.connect()
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {os.path.basename(path).split('.')[0]} AS SELECT * FROM read_parquet('{files}')")
    return c


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value.isoformat() if hasattr(value, "isoformat") else value


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


def compare(df, cursor):
    columns = sorted(df.columns)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = in_order([tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()])
    got = in_order([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    assert got == want
