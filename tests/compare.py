"""Run a registered query and its DuckDB text on the same tables and compare the rows."""

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def compare(spark, con, run, oracle, sf_dir):
    """(spark rows, oracle rows, list of differences)."""
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    got = Counter(tuple(norm(r[n]) for n in names) for r in df.collect())
    cur = con.execute(oracle)
    cols = [c[0] for c in cur.description]
    if sorted(cols) != names:
        return sum(got.values()), -1, [f"columns {sorted(set(cols) ^ set(names))}"]
    order = [cols.index(n) for n in names]
    want = Counter(tuple(norm(r[i]) for i in order) for r in cur.fetchall())
    diffs = []
    if got != want:
        only_spark, only_duck = list((got - want).items())[:2], list((want - got).items())[:2]
        for a, b in zip(only_spark, only_duck):
            diffs.append({n: (x, y) for n, x, y in zip(names, a[0], b[0]) if x != y})
        diffs.append(f"spark only {sum((got - want).values())}, oracle only {sum((want - got).values())}")
    return sum(got.values()), sum(want.values()), diffs
