"""Rows of a Spark query and of its SQL on DuckDB, comparable."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, bytes)):
        return v
    if isinstance(v, float):
        return None if v != v else float(f"{v:.8g}")
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return float(f"{float(v):.8g}") if isinstance(v, int) and abs(v) < 2**53 else v


def rows(table):
    cols = sorted(table.column_names)
    return cols, sorted((repr([plain(r[c]) for c in cols]) for r in table.to_pylist()))
