"""Benchmark of the headline analyses.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full through Spark's no-op sink (nothing is
collected to the driver). Each query runs $BENCH_RUNS times (default 2);
the reported time is the best run. Before timing, every query runs once
on the smallest tables ($BENCH_WARMUP_DIR, default /root/testdata/sf0.001)
so JVM start-up is not charged to the first query. ``documents`` is one file of
one row group: its rows are dealt to $BENCH_PARTITIONS tasks (default: cpus; 0:
as read).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillspark.plans.inputs import PARTITIONS  # noqa: E402
from quillspark.plans.queries import queries  # noqa: E402
from quillspark.session import get_session  # noqa: E402

HEADLINE = ["word_counts", "tf_idf", "top_terms", "sentiment_arc", "sentiment_decile", "tfidf_decile",
            "cooccurrence", "cooccurrence_share", "number_turns", "annotate_structure", "compare_vocab",
            "words_per_role"]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    if int(os.environ.get("BENCH_PARTITIONS", cpus)):
        extra[PARTITIONS] = os.environ.get("BENCH_PARTITIONS", str(cpus))
    spark = get_session(f"local[{cpus}]", app="quillspark-bench", shuffle_partitions=max(8, 2 * cpus), extra=extra)
    qs = queries()
    # untimed warm-up on the smallest tables: JVM start-up and code
    # generation are not charged to the first timed query
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, base).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", base)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
