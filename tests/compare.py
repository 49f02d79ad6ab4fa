"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import duckdb
import pathlib


def duck(sf_dir):
    con = duckdb.connect()
    for f in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def of_spark(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def of_duck(con, sql):
    cur = con.execute(sql)
    return _sorted([d[0] for d in cur.description], cur.fetchall())
