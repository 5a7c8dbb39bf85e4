"""Run a registered query and its SQL on the same files and compare types, row counts and values."""

from __future__ import annotations

import datetime as dt
import decimal

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", str(v))
    if isinstance(v, float):
        return v + 0.0
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return [norm(x) for x in v.values()]
    if hasattr(v, "asDict"):
        return [norm(x) for x in v]
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([[norm(row[i]) for i in order] for row in data], key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """Problems as text, or None when both sides agree."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(x) for x in df.collect()])
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want = rows(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0][0])[:400]} != {str(bad[0][1])[:400]}"
    return None if got else "no rows"
