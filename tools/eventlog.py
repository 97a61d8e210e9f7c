"""Summarize stage and task times from a Spark event log folder (written by
`BENCH_EVENT_LOG=<folder> python bench.py`); plain or zstd-compressed logs.

usage: python tools/eventlog.py <folder> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as f:
            reader = zstandard.ZstdDecompressor().stream_reader(f)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    files = []
    for dirpath, _, names in os.walk(root):
        files += [os.path.join(dirpath, n) for n in names if n.startswith("events") or n.startswith("local-")]
    stages, task_ms = {}, 0
    for path in sorted(files):
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif e.get("Event") == "SparkListenerTaskEnd":
                task_ms += e.get("Task Info", {}).get("Finish Time", 0) - e.get("Task Info", {}).get("Launch Time", 0)
    print(f"stages {len(stages)}  tasks {sum(v[1] for v in stages.values())}  "
          f"stage wall ms {sum(v[2] for v in stages.values())}  task ms {task_ms}")
    for sid, (name, n, ms) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]:
        print(f"  stage {sid:4d}  {ms:6d} ms  {n:4d} tasks  {name}")


if __name__ == "__main__":
    main()
