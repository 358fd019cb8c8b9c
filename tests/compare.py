"""Value-by-value comparison of a query with its SQL on DuckDB."""

from __future__ import annotations

import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(float(value)) if abs(value) < 2 ** 53 else repr(int(value))
    return str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def from_spark(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def from_duck(con, sql):
    cur = con.execute(sql)
    return table([c[0] for c in cur.description], cur.fetchall())


def difference(left, right) -> str | None:
    """None when equal, else a short account of what differs."""
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if left[1] == right[1]:
        return None
    a, b = set(left[1]), set(right[1])
    only_a, only_b = sorted(a - b)[:3], sorted(b - a)[:3]
    return (f"rows {len(left[1])} vs {len(right[1])}; only left {len(a - b)} {only_a}; "
            f"only right {len(b - a)} {only_b}")
