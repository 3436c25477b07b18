"""Stage times of registered queries from Spark's event log.

usage: python tools/stage_times.py <sf_dir> <query> [query ...]

Runs each query through the no-op sink with the event log written to a new
scratch folder, then prints, per query, every stage with its task count,
wall time, and shuffle read/write volume (no Spark UI involved).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillspark.plans.queries import queries  # noqa: E402
from quillspark.session import get_session  # noqa: E402


def main() -> None:
    base, names = sys.argv[1], sys.argv[2:]
    logdir = tempfile.mkdtemp(prefix="qs-eventlog-")
    spark = get_session("local[8]", app="quillspark-stages", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    marks = []
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        queries()[name](spark, base).write.format("noop").mode("overwrite").save()
        marks.append((name, t0, time.time()))
    spark.stop()
    stages, job_group = [], {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        job_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                    stages.append((info["Stage ID"], info.get("Stage Name", ""), info["Number of Tasks"],
                                   info.get("Submission Time", 0), info.get("Completion Time", 0),
                                   acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0,
                                   acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0,
                                   acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0))
    for name, t0, t1 in marks:
        print(f"== {name}: {t1 - t0:.2f}s")
        for sid, sname, ntask, sub, comp, rr, lr, wb in sorted(stages):
            if job_group.get(sid) != name:
                continue
            print(f"  stage {sid:4d} tasks={ntask:4d} {(comp - sub) / 1000:6.2f}s "
                  f"shuffle_read={(int(rr) + int(lr)) / 1e6:8.2f}MB shuffle_write={int(wb) / 1e6:8.2f}MB  {sname[:60]}")


if __name__ == "__main__":
    main()
