"""Summarize a Spark event log by job group: jobs, stages, tasks and the
summed wall time of jobs, per query name (as tagged by bench.py).

Usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str):
    """Event files under ``path`` (Spark 4 writes a folder per application
    holding ``events_<n>_<app>`` parts, zstd-compressed by default)."""
    if os.path.isfile(path):
        yield path
        return
    for root, _, names in sorted(os.walk(path)):
        for n in sorted(names):
            if n.startswith("events_") or n.startswith("local-") or n.startswith("app-"):
                yield os.path.join(root, n)


def _lines(f: str):
    if f.endswith(".zstd") or f.endswith(".zst"):
        import io

        import zstandard

        with open(f, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def events(path: str):
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main(path: str) -> None:
    job_group, job_start, stats = {}, {}, defaultdict(lambda: defaultdict(float))
    stage_group = {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            g = props.get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = g
            job_start[e["Job ID"]] = e["Submission Time"]
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
            stats[g]["jobs"] += 1
        elif kind == "SparkListenerJobEnd":
            g = job_group.get(e["Job ID"], "-")
            stats[g]["job_ms"] += e["Completion Time"] - job_start.get(e["Job ID"], e["Completion Time"])
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            g = stage_group.get(info["Stage ID"], "-")
            stats[g]["stages"] += 1
            stats[g]["tasks"] += info.get("Number of Tasks", 0)
    print(f"{'query':36s} {'jobs':>6s} {'stages':>7s} {'tasks':>7s} {'job s':>8s}")
    for g, s in sorted(stats.items()):
        print(f"{g:36s} {int(s['jobs']):6d} {int(s['stages']):7d} {int(s['tasks']):7d} "
              f"{s['job_ms'] / 1000:8.2f}")


if __name__ == "__main__":
    main(sys.argv[1])
