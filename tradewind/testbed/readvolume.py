"""What queries read, from Spark's event log: bytes that tasks read, and files opened by table."""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator


def _scans(node: dict) -> Iterator[dict]:
    if node["nodeName"].startswith("Scan "):
        yield node
    for child in node["children"]:
        yield from _scans(child)


def _events(folder: str) -> Iterator[dict]:
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        if os.path.isdir(path):
            yield from _events(path)
        elif not name.startswith((".", "appstatus")):
            with open(path, encoding="utf-8") as lines:
                for line in lines:
                    yield json.loads(line)


def by_group(folder: str) -> dict[str, dict]:
    """Per job group: bytes read by tasks, CPU milliseconds, and files and their bytes by table folder.

    ``folder`` is what ``spark.eventLog.dir`` named, uncompressed. A table's files are those its
    scans opened after pruning; the bytes that tasks read of them are fewer where columns or pages
    were skipped.
    """
    group_of_stage: dict[int, str] = {}
    group_of_execution: dict[str, str] = {}
    scans: dict[int, tuple[str, str, str]] = {}
    found: dict[str, dict] = defaultdict(lambda: {"bytes_read": 0, "cpu_ms": 0.0, "tables": defaultdict(lambda: [0, 0])})
    values: dict[int, int] = {}
    for event in _events(folder):
        kind = event["Event"].rsplit(".", 1)[-1]
        if kind == "SparkListenerJobStart":
            properties = event.get("Properties") or {}
            group = properties.get("spark.jobGroup.id")
            if group:
                group_of_stage |= {s: group for s in event["Stage IDs"]}
                if "spark.sql.execution.id" in properties:
                    group_of_execution[properties["spark.sql.execution.id"]] = group
        elif kind == "SparkListenerTaskEnd" and event["Stage ID"] in group_of_stage and event.get("Task Metrics"):
            of = found[group_of_stage[event["Stage ID"]]]
            of["bytes_read"] += event["Task Metrics"]["Input Metrics"]["Bytes Read"]
            of["cpu_ms"] += event["Task Metrics"]["Executor CPU Time"] / 1e6
        elif kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            for scan in _scans(event["sparkPlanInfo"]):
                place = re.search(r"\[[a-z]*:?([^,\]]+)", scan["metadata"].get("Location", ""))
                table = os.path.basename(place.group(1).rstrip("/")) if place else "?"
                for metric in scan["metrics"]:
                    scans[metric["accumulatorId"]] = (str(event["executionId"]), table, metric["name"])
        elif kind == "SparkListenerDriverAccumUpdates":
            values |= {int(i): int(v) for i, v in event["accumUpdates"]}
    for number, value in values.items():
        execution, table, name = scans.get(number, ("", "", ""))
        group = group_of_execution.get(execution)
        if group and name in ("number of files read", "size of files read"):
            found[group]["tables"][table][name.startswith("size")] += value
    return {
        g: {"bytes_read": v["bytes_read"], "cpu_ms": round(v["cpu_ms"], 1)}
        | {"tables": {t: {"files": n, "bytes": size} for t, (n, size) in sorted(v["tables"].items())}}
        for g, v in found.items()
    }
