"""Summarise job and stage wall times from a Spark event log folder.

Usage: python scripts/stage_times.py <event log dir> [top_n]
(bench.py writes one when BENCH_EVENT_LOG_DIR is set; the Spark UI stays off.)
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main():
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)) or \
        sorted(p for p in glob.glob(os.path.join(root, "*")) if os.path.isfile(p))
    stages, jobs = [], {}
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages.append((ms, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e.get("Properties", {}).get("spark.job.description")]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
    print(f"{len(jobs)} jobs, {len(stages)} stages, job time {sum((c or s) - s for s, c, _ in jobs.values()) / 1000:.1f}s")
    for ms, sid, ntasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:8.2f}s  stage {sid:4d}  tasks {ntasks:5d}  {name}")


if __name__ == "__main__":
    main()
