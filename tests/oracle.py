"""Order-insensitive comparison of a Spark result with DuckDB running the equivalent SQL."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(problem or None, number of rows)."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = _rows(columns, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    if got != expected:
        only_got = [r for r in got if r not in set(expected)][:3]
        only_expected = [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows != {len(expected)}: only Spark {only_got}, only SQL {only_expected}", len(got)
    return None, len(got)
