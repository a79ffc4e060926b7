"""Benchmark: ingest once, then the decision queries over the stored models.

Mirrors how the original system is used: events are cleaned and written into
every model once (``ingest``), then questions are answered from the stored
tables.  Prints one JSON line:
{"metric": "query_total_sec", "value": N, "unit": "sec", "queries": {...},
 "sf": ..., "ingest_sec": ...}
Each query time is the warm median of three runs (results are collected).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowlens.plans import model  # noqa: E402
from flowlens.plans.registry import registry  # noqa: E402
from flowlens.session import get_session  # noqa: E402

HEADLINE = [
    "q1_s", "q2_s", "q3_s", "q4_s", "q5_s", "q6_s", "q7_s", "q9_s", "q10_s", "q11_s", "q12_s",
    "q1_f", "q2_f", "q3_f", "q4_f", "q5_f", "q6_f", "q7_f", "q8_f", "q9_f", "q10_f", "q11_f", "q12_f",
    "q1_d", "q3_d", "q5_d", "q7_d", "q9_d", "q11_d", "q12_d",
    "q1_g", "q3_g", "q6_g", "q8_g", "q9_g", "q11_g",
    "kpis", "day_of_week_heatmap", "weekly_trend", "country_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    warehouse = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="bench-wh-")
    warehouse = os.path.join(warehouse.replace("file:", ""), f"warehouse-{os.getpid()}")

    t0 = time.time()
    tables = model.build_tables(spark, sf_dir)
    names = [n for n in model.MODEL_ORDER]
    model.write_tables(tables, warehouse, names)
    ingest = time.time() - t0

    stored = model.read_tables(spark, warehouse, names)
    stored["raw_flows"] = tables["raw_flows"]
    stored["flow_events"] = tables["flow_events"]
    reg = registry()
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = reg[name]
        runs = []
        for _ in range(3):
            s = time.time()
            fn(stored).collect()
            runs.append(time.time() - s)
        times[name] = round(statistics.median(runs), 4)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "query_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "ingest_sec": round(ingest, 3), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
