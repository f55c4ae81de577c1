"""Summarise a Spark event log: slowest stages with task count and shuffle
bytes (the Spark UI stays off; this reads the log file instead).

Usage: python tools/eventlog_stages.py <event-log-file-or-dir> [top_n]

Produce a log with ``BENCH_EVENTLOG=1 python bench.py`` (written under the
bench's fresh scratch folder).
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event log files under ``path`` (Spark 4 writes rolling logs as a
    folder of ``events_*`` files next to an empty ``appstatus_*`` marker)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for d, _, files in os.walk(path):
        out += [os.path.join(d, f) for f in sorted(files)
                if not f.startswith(("appstatus", ".")) and not f.endswith(".crc")]
    return out


def _lines(f: str):
    """Lines of a plain or zstd-compressed (Spark 4 default) event log."""
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    shuffle_write = defaultdict(int)
    shuffle_read = defaultdict(int)
    stages = []
    for f in _files(path):
        for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sid = ev["Stage ID"]
                    shuffle_write[sid] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    rd = m.get("Shuffle Read Metrics") or {}
                    shuffle_read[sid] += rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                    stages.append((dur, info["Stage ID"], info.get("Number of Tasks"), info.get("Stage Name", "")))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"stages={len(stages)} summed_stage_ms={total}")
    for dur, sid, ntasks, name in stages[:top]:
        print(f"{dur:8d} ms  stage {sid:5d}  tasks {ntasks:5d}  shuffle_w {shuffle_write[sid]:>12,d}  "
              f"shuffle_r {shuffle_read[sid]:>12,d}  {name[:60]}")


if __name__ == "__main__":
    main()
