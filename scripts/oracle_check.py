"""Run registered queries on Spark and their DuckDB oracle side by side.

usage: python scripts/oracle_check.py [sf_dir] [name-substring ...]
Compares row count, column names and the sorted rows (floats rounded to 6 places).
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

sys.path.insert(0, ".")
from corpusflow.queries.registry import load_all  # noqa: E402
from corpusflow.session import build_session  # noqa: E402
from corpusflow.testing import sorted_rows  # noqa: E402
from corpusflow.sources.tables import TABLES  # noqa: E402


def rows_of(cols, rows):
    c, r = sorted_rows(cols, rows)
    return r, c


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    reg = load_all()
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name, q in sorted(reg.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
        except Exception:
            print(f"FAIL-SPARK {name}: {str(sys.exc_info()[1])[:600]}")
            bad += 1
            continue
        dt = time.time() - t0
        if q.sql is None:
            print(f"ROWS-ONLY {name}: {len(srows)} rows {dt:.1f}s")
            ok += 1
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:
            print(f"FAIL-SQL {name}: {e}")
            bad += 1
            continue
        s_sorted, s_c = rows_of(scols, srows)
        d_sorted, d_c = rows_of(dcols, drows)
        if s_c != d_c:
            print(f"MISMATCH-COLS {name}: spark={s_c} duck={d_c}")
            bad += 1
        elif len(s_sorted) != len(d_sorted):
            print(f"MISMATCH-COUNT {name}: spark={len(s_sorted)} duck={len(d_sorted)}")
            bad += 1
        elif s_sorted != d_sorted:
            diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:2]
            print(f"MISMATCH-VALUES {name}: {len(srows)} rows; first diffs:")
            for a, b in diff:
                print("   spark:", str(a)[:400])
                print("   duck :", str(b)[:400])
            bad += 1
        else:
            print(f"OK {name}: {len(srows)} rows {dt:.1f}s types={dict(zip(scols, stypes))}"[:300])
            ok += 1
    print(f"== {ok} ok, {bad} bad")


if __name__ == "__main__":
    main()
