"""Local stand-in for the driver's correctness gate.

Runs each registered query on Spark and its oracle SQL on DuckDB over the
same parquet directory and compares row count, column names and an
order-insensitive hash of normalised values.

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        # ORACLE_STRICT=1 compares doubles bit for bit (exact repr)
        return repr(v) if os.environ.get("ORACLE_STRICT") else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main():
    import duckdb

    from tidewater.registry import all_oracles, all_queries
    from tidewater.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = all_queries(), all_oracles()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(orc[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        if ok:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: spark {len(rows)} rows {sorted(cols)}\n     duck  {len(orows)} rows {sorted(ocols)}")
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("     spark-only:", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("     duck-only: ", x[:300])
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
