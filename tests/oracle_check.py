"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [--exact] [name ...]
Prints one line per query: OK / MISMATCH with details. Exit 1 on any mismatch.
Values are compared as Python objects from collect() / fetchall(); floats are
rounded to 6 decimals unless --exact.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, con, name: str, sf_dir: str, verbose: bool = True) -> bool:
    import __spark_entry__ as entry

    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        print(f"{name:32s} ROWS-ONLY spark={len(s_rows)} ({t1 - t0:.1f}s)")
        return True
    res = con.sql(sql)
    o_cols = res.columns
    o_types = dict(zip(o_cols, [str(t) for t in res.types]))
    o_rows = res.fetchall()
    ok = True
    msgs = []
    if sorted(s_cols) != sorted(o_cols):
        ok = False
        msgs.append(f"columns differ: spark-only={sorted(set(s_cols) - set(o_cols))} "
                    f"oracle-only={sorted(set(o_cols) - set(s_cols))}")
    if len(s_rows) != len(o_rows):
        ok = False
        msgs.append(f"rows spark={len(s_rows)} oracle={len(o_rows)}")
    if ok:
        a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
        if a != b:
            ok = False
            cols = sorted(s_cols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                d = {c: (xv, yv) for c, xv, yv in zip(cols, x, y) if xv != yv}
                msgs.append(f"value diff: {d}")
    type_notes = {c: (s_types[c], o_types[c]) for c in s_cols if c in o_types
                  and not _type_ok(s_types[c], o_types[c])}
    if type_notes:
        msgs.append(f"types: {type_notes}")
    status = "OK" if ok else "MISMATCH"
    print(f"{name:32s} {status} rows={len(s_rows)} ({t1 - t0:.1f}s)")
    if verbose:
        for m in msgs:
            print("    " + m)
    return ok


def _type_ok(s: str, o: str) -> bool:
    pairs = {
        ("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
        ("date", "DATE"), ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP"),
    }
    return (s, o) in pairs


def main(argv):
    from subledger.session import get_spark

    global EXACT
    if "--exact" in argv:
        argv = [a for a in argv if a != "--exact"]
        EXACT = True
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry

    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    names = names or sorted(entry.queries())
    bad = []
    for n in names:
        try:
            if not compare(spark, con, n, sf_dir):
                bad.append(n)
        except Exception as exc:  # report and continue
            print(f"{n:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            bad.append(n)
    print(f"\n{len(names) - len(bad)}/{len(names)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
