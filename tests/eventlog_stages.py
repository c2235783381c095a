"""Per-stage times from a Spark event log (written with BENCH_EVENTLOG_DIR).

Usage: python tests/eventlog_stages.py <event-log-dir>
Prints one line per stage: job group (the bench query), tasks, stage time,
slowest task and summed task time, so single-task or skewed stages stand out.
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def events(log_dir: str):
    for fn in sorted(glob.glob(f"{log_dir}/eventlog_v2_*/events_*")):
        data = open(fn, "rb").read()
        if fn.endswith(".zstd"):
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read()
        for line in data.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    stages, group, tasks = {}, {}, {}
    for e in events(sys.argv[1]):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                group[s] = g
        elif ev == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (group.get(si["Stage ID"]), si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Stage Name"][:50])
    for sid, (g, n, dur, name) in sorted(stages.items()):
        t = tasks.get(sid, [])
        print(f"{g or '-':28s} stage {sid:4d} tasks {n:3d} ms {dur:6d} max_task {max(t) if t else 0:6d} "
              f"sum_task {sum(t):7d} {name}")


if __name__ == "__main__":
    main()
