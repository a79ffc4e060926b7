"""Time the DuckDB oracle (end-to-end from events) for the bench queries.

Usage: python tools/duckdb_baseline.py [sf_dir]
Prints one JSON line with warm medians of three runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from flowlens.oracle import oracle_sql  # noqa: E402
from tools.check_oracle import TABLES  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    ora = oracle_sql()
    out = {}
    for name in HEADLINE:
        if name not in ora:
            continue
        runs = []
        for _ in range(3):
            s = time.time()
            con.execute(ora[name]).fetchall()
            runs.append(time.time() - s)
        out[name] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "sf": sf, "total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
