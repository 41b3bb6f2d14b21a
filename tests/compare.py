"""Compare registered queries with their DuckDB texts.

    python tests/compare.py [sf] [name fragment ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


KINDS = {
    "bigint": "bigint", "int": "integer", "string": "varchar", "double": "double", "boolean": "boolean",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date",
}


def run(spark, con, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in cols]).collect()
    got = sorted(tuple(plain(v) for v in r) for r in rows)
    if sql is None:
        return f"{len(got)} rows, no SQL", True
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_raw = cur.fetchall()
    if sorted(names) != cols:
        return f"columns {cols} <> {sorted(names)}", False
    kinds = dict(zip(names, [str(d[1]).lower() for d in cur.description]))
    odd = {
        c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]
    }
    index = [names.index(c) for c in cols]
    want = sorted(tuple(plain(r[k]) for k in index) for r in want_raw)
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} <> {len(want)} rows\n   cols {cols}\n   spark {only_got}\n   duck  {only_want}", False
    if odd:
        return f"{len(got)} rows equal, types differ: {odd}", False
    return f"{len(got)} rows" + (" EMPTY" if not got else ""), True


def main() -> int:
    from simquarry.session import builder
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        builder().master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, texts = entry.queries(), entry.oracle_sql()
    bad = []
    for name, query in queries.items():
        if wanted and not any(name.startswith(w) if w[-1] == "_" else w in name for w in wanted):
            continue
        start = time.time()
        try:
            message, ok = run(spark, con, sf_dir, name, query, texts.get(name))
        except Exception as e:
            message, ok = f"{type(e).__name__}: {str(e)[:1500]}", False
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.2f}s {message}", flush=True)
        if not ok:
            bad.append(name)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
