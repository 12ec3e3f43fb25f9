"""Run registered queries in Spark and their check SQL in DuckDB and compare.

    python tools/check_oracles.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def kind(name: str) -> str:
    n = name.lower()
    if n.startswith(("timestamp",)):
        return "timestamp"
    return {"bigint": "bigint", "long": "bigint", "integer": "int", "string": "varchar", "varchar": "varchar",
            "hugeint": "hugeint"}.get(n, n)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    if cols != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {cols}"
    st = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema}
    dtp = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    types = {c: (st[c], dtp[c]) for c in cols if st[c] != dtp[c]
             and not any(x in st[c] for x in ("array", "struct", "map"))}
    if types:
        return f"types {types}"
    di = [rel.columns.index(c) for c in cols]
    si = [spark_df.columns.index(c) for c in cols]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    d = sorted((tuple(norm(r[i]) for i in di) for r in rel.fetchall()), key=key)
    s = sorted((tuple(norm(r[i]) for i in si) for r in spark_df.collect()), key=key)
    if len(d) != len(s):
        return f"rows spark {len(s)} duckdb {len(d)}"
    if not s:
        return "empty result"
    for a, b in zip(s, d):
        if a != b:
            diff = {c: (x, y) for c, x, y in zip(cols, a, b) if x != y}
            return f"first difference {str(diff)[:600]}"
    return None


def main(argv: list[str]) -> int:
    from stratamart.queries import REGISTRY
    from stratamart.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    con, bad = duck(sf_dir), 0
    for name, q in REGISTRY.items():
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        t = time.time()
        try:
            df = q.run(spark, sf_dir)
            problem = compare(df, con, q.sql) if q.sql else (None if df.count() else "empty result")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "BAD "
        print(f"{mark} {name} {'' if q.sql else '(rows only) '}{time.time() - t:.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
