"""Run registered queries in Spark and their SQL in DuckDB and compare.

usage: python tools/check_oracle.py [sf_dir] [name ...]
Prints one line per query: ok / MISMATCH with row counts and column info.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quillspark.session import get_session  # noqa: E402
from quillspark.plans.oracle import oracle_sql  # noqa: E402
from quillspark.plans.queries import queries  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(norm(x) for x in rec) for rec in zip(*data))


def main():
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    qs, sql = queries(), oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, base)
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            spdf = sdf.toArrow()
            t1 = time.time()
            if name not in sql:
                print(f"{name:22s} rows={spdf.num_rows} (no sql) {t1-t0:.1f}s", flush=True)
                continue
            rel = con.sql(sql[name])
            dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
            dpdf = rel.to_arrow_table()
            c1, r1 = rows_of(spdf)
            c2, r2 = rows_of(dpdf)
            tmap = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                    "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}
            type_diff = {k: (v, dtypes.get(k)) for k, v in stypes.items() if tmap.get(v, v) != dtypes.get(k)}
            if type_diff:
                print(f"{name:22s} TYPES differ: {type_diff}", flush=True)
            ok = c1 == c2 and r1 == r2
            msg = "ok" if ok else "MISMATCH"
            extra = ""
            if not ok:
                bad += 1
                extra = f" cols {c1} vs {c2}; rows {len(r1)} vs {len(r2)}"
                if c1 == c2 and len(r1) == len(r2):
                    diff = [(a, b) for a, b in zip(r1, r2) if a != b][:2]
                    extra += f" diff {diff}"
                elif c1 == c2:
                    s1, s2 = set(r1), set(r2)
                    extra += f" only_spark {list(s1 - s2)[:2]} only_sql {list(s2 - s1)[:2]}"
            print(f"{name:22s} {msg} rows={len(r1)} {t1-t0:.1f}s types spark={stypes} duck={dtypes}{extra}"
                  if not ok else f"{name:22s} ok rows={len(r1)} {t1-t0:.1f}s", flush=True)
        except Exception as e:  # keep going
            bad += 1
            print(f"{name:22s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"bad={bad}")


if __name__ == "__main__":
    main()
