"""What the file scans of a Spark event log read: partitions, files, rows.

Usage: python tools/scan_report.py <event-log-file-or-dir>

Each scan of an executed plan is listed once, with its location, its filters
and its metrics; a table that is read twice shows twice.
"""

from __future__ import annotations

import json
import os
import re
import sys
from dataclasses import dataclass, field

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventlog_stages import _files, _lines  # noqa: E402


@dataclass
class Scan:
    execution: int
    kind: str
    location: str
    filters: str
    accumulators: dict[int, str]
    metrics: dict[str, int] = field(default_factory=dict)

    @property
    def partitions(self) -> int:
        return self.metrics.get("number of partitions read", 0)

    @property
    def files(self) -> int:
        return self.metrics.get("number of files read", 0)

    @property
    def rows(self) -> int:
        return self.metrics.get("number of output rows", 0)


def _nodes(info: dict):
    yield info
    for child in info.get("children", []):
        yield from _nodes(child)


def sizes(path: str) -> dict[str, int]:
    """How far each file of a log is written."""
    return {file: os.path.getsize(file) for file in _files(path)}


def _lines_from(file: str, start: int):
    if not start:
        yield from _lines(file)
        return
    with open(file, "rb") as log:
        log.seek(start)
        yield from log


def scans(path: str, start: dict[str, int] | None = None) -> list[Scan]:
    """Scans in order, of what was logged after ``start`` (see ``sizes``; plain
    files only)."""
    found: dict[frozenset, Scan] = {}
    values: dict[int, int] = {}
    for file in _files(path):
        for line in _lines_from(file, (start or {}).get(file, 0)):
            try:
                event = json.loads(line)
            except json.JSONDecodeError:               # the line being written
                continue
            kind = event.get("Event", "").rsplit(".", 1)[-1]
            if kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
                for node in _nodes(event["sparkPlanInfo"]):
                    name = node["nodeName"].strip()
                    if not re.match(r"(Scan|BatchScan) ", name):
                        continue
                    meta = node.get("metadata", {})
                    accumulators = {m["accumulatorId"]: m["name"] for m in node["metrics"]}
                    found.setdefault(frozenset(accumulators), Scan(
                        event["executionId"], name, meta.get("Location", f"{name} {node['simpleString']}"),
                        meta.get("PartitionFilters", ""), accumulators))
            elif kind == "SparkListenerDriverAccumUpdates":
                values.update({k: v for k, v in event["accumUpdates"]})
            elif kind == "SparkListenerStageCompleted":
                for a in event["Stage Info"].get("Accumulables", []):
                    if str(a.get("Value", "")).isdigit():
                        values[a["ID"]] = int(a["Value"])
    for scan in found.values():
        scan.metrics = {name: values[i] for i, name in scan.accumulators.items() if i in values}
    return list(found.values())


def main() -> None:
    for s in scans(sys.argv[1]):
        print(f"{s.execution:5d} {s.kind:28.28s} partitions {s.partitions:6d} files {s.files:6d} rows {s.rows:10d}  "
              f"{s.location[:100]}  {s.filters[:120]}")


if __name__ == "__main__":
    main()
