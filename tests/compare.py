"""Order-insensitive comparison of a Spark result with a DuckDB result on the same tables."""

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{canon(k)}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def difference(con, df, sql):
    """None when equal, otherwise a short description."""
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rows_of(names, rel.fetchall())
    got_rows = df.collect()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = rows_of(df.columns, got_rows)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; got {got[:2]} want {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; first got {bad[0][0]} want {bad[0][1]}"
    return None
