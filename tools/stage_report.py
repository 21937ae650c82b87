"""Per-stage task statistics from a Spark event log.

Usage: python tools/stage_report.py <event-log-file> [min_tasks]
Prints, per completed stage: task count, median and max task time, the
max/median ratio (skew) and shuffle read/write bytes. Run a job with
``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set to a scratch
folder to produce the log (the web UI stays off).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _part_no(name: str) -> int:
    parts = name.split("_")
    return int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else 0


def _lines(files):
    """Lines of plain or zstd-compressed (Spark's default codec) log files."""
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    min_tasks = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    tasks = defaultdict(list)
    names = {}
    # Spark 4 writes a rolling log: a folder of events_<n>_* files.
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path), key=_part_no)
              if f.startswith("events_")] if os.path.isdir(path) else [path])
    for line in _lines(files):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            info, m = ev["Task Info"], ev.get("Task Metrics") or {}
            dur = info["Finish Time"] - info["Launch Time"]
            rd = (m.get("Shuffle Read Metrics") or {})
            wr = (m.get("Shuffle Write Metrics") or {})
            tasks[ev["Stage ID"]].append((
                dur, rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0),
                wr.get("Shuffle Bytes Written", 0)))
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            names[si["Stage ID"]] = si["Stage Name"].split(" at ")[0][:40]
    print(f"{'stage':>5s} {'tasks':>6s} {'med ms':>7s} {'max ms':>7s} {'skew':>5s} "
          f"{'shuf rd MB':>10s} {'shuf wr MB':>10s}  name")
    for sid in sorted(tasks):
        t = tasks[sid]
        if len(t) < min_tasks:
            continue
        durs = [x[0] for x in t]
        med = statistics.median(durs)
        print(f"{sid:5d} {len(t):6d} {med:7.0f} {max(durs):7d} {max(durs) / max(med, 1):5.1f} "
              f"{sum(x[1] for x in t) / 1e6:10.2f} {sum(x[2] for x in t) / 1e6:10.2f}  "
              f"{names.get(sid, '')}")


if __name__ == "__main__":
    main()
