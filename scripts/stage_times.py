"""Summarize a Spark event log folder written by ``BENCH_EVENT_LOG=<dir>``.

Usage: python scripts/stage_times.py <dir> [top_n]
Prints job and stage totals and the slowest stages with their task counts
(low task counts on slow stages point at lost parallelism).
"""

from __future__ import annotations

import glob
import json
import os
import sys


def read_events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)):
        with open(path, "rb") as fh:
            if path.endswith(".zstd"):
                import zstandard

                data = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True).read()
            else:
                data = fh.read()
        for line in data.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, job_start, jobs = [], {}, {}
    for e in read_events(folder):
        kind = e["Event"]
        if kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((secs, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:60]))
        elif kind == "SparkListenerJobStart":
            job_start[e["Job ID"]] = e["Submission Time"]
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]] = (e["Completion Time"] - job_start[e["Job ID"]]) / 1000
    print(f"jobs {len(jobs)}  job seconds {sum(jobs.values()):.2f}")
    print(f"stages {len(stages)}  stage seconds {sum(s[0] for s in stages):.2f}")
    for secs, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{secs:7.2f}s  stage {sid:5d}  tasks {tasks:4d}  {name}")


if __name__ == "__main__":
    main()
