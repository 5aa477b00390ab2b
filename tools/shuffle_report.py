"""Per job at a scale factor: stages, tasks and shuffle bytes written,
from Spark's event log (written to a fresh scratch folder).

    python tools/shuffle_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from billetic.plans.registry import QUERIES  # noqa: E402
from billetic.session import build_session  # noqa: E402
from billetic.streaming import JOBS  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for name in JOBS:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stats: dict[str, dict[str, int]] = {}
    job_group: dict[int, str] = {}
    stage_job: dict[int, str] = {}
    paths = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True)
             if os.path.isfile(p) and "appstatus" not in os.path.basename(p)]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        job_group[ev["Job ID"]] = group
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    name = stage_job.get(info["Stage ID"])
                    if name is None or "Completion Time" not in info:
                        continue
                    s = stats.setdefault(name, {"stages": 0, "tasks": 0, "shuffle": 0})
                    s["stages"] += 1
                    s["tasks"] += info.get("Number of Tasks", 0)
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            s["shuffle"] += int(acc.get("Value", 0))
    print("| job | stages | tasks | shuffle written (KiB) |")
    print("| --- | ---: | ---: | ---: |")
    for name in JOBS:
        s = stats.get(name, {})
        print(f"| {name} | {s.get('stages', 0)} | {s.get('tasks', 0)} | "
              f"{s.get('shuffle', 0) / 1024:.0f} |")


if __name__ == "__main__":
    main()
