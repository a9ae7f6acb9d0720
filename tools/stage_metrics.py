"""Task and shuffle figures per job group, read from Spark's event log.

Usage: python tools/stage_metrics.py EVENT_LOG_DIR

A session started with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=DIR`` writes its events under ``DIR``. Jobs run under
``sparkContext.setJobGroup(name, ...)`` are summed per ``name``: tasks,
scan input, shuffle written (bytes and records) and read, and the largest
single task's shuffle read and run time (the figures that show a hot task).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict
from collections.abc import Iterator


def _open(path: str) -> io.TextIOBase:
    if path.endswith(".zstd"):
        import zstandard

        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), "utf-8")
    return open(path, encoding="utf-8")


def _event_files(log_dir: str) -> list[str]:
    """Rolling logs (``eventlog_v2_*/events_N_*``) and single-file logs alike."""
    rolling = glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*"))
    if rolling:
        return sorted(rolling, key=lambda p: int(os.path.basename(p).split("_")[1]))
    return sorted(p for p in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(p) and not p.endswith(".crc"))


def events(log_dir: str) -> Iterator[dict]:
    for path in _event_files(log_dir):
        with _open(path) as f:
            for line in f:
                if line.strip():
                    yield json.loads(line)


def by_group(log_dir: str) -> dict[str, dict[str, int]]:
    """``{job group: figures}`` over successful tasks of the group's jobs."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(
        lambda: {
            "jobs": 0,
            "tasks": 0,
            "input_bytes": 0,
            "input_records": 0,
            "shuffle_write_bytes": 0,
            "shuffle_write_records": 0,
            "shuffle_read_bytes": 0,
            "shuffle_read_records": 0,
            "max_task_shuffle_read_bytes": 0,
            "max_task_shuffle_read_records": 0,
            "max_task_run_ms": 0,
        }
    )
    for e in events(log_dir):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            if group is None:
                continue
            out[group]["jobs"] += 1
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(e.get("Stage ID"))
            if group is None or e.get("Task End Reason", {}).get("Reason") != "Success":
                continue
            m = e.get("Task Metrics") or {}
            inp = m.get("Input Metrics", {})
            sr = m.get("Shuffle Read Metrics", {})
            sw = m.get("Shuffle Write Metrics", {})
            read_bytes = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            read_records = sr.get("Total Records Read", 0)
            g = out[group]
            g["tasks"] += 1
            g["input_bytes"] += inp.get("Bytes Read", 0)
            g["input_records"] += inp.get("Records Read", 0)
            g["shuffle_write_bytes"] += sw.get("Shuffle Bytes Written", 0)
            g["shuffle_write_records"] += sw.get("Shuffle Records Written", 0)
            g["shuffle_read_bytes"] += read_bytes
            g["shuffle_read_records"] += read_records
            g["max_task_shuffle_read_bytes"] = max(g["max_task_shuffle_read_bytes"], read_bytes)
            g["max_task_shuffle_read_records"] = max(g["max_task_shuffle_read_records"], read_records)
            g["max_task_run_ms"] = max(g["max_task_run_ms"], m.get("Executor Run Time", 0))
    return dict(out)


def main() -> None:
    for group, figures in sorted(by_group(sys.argv[1]).items()):
        print(group, json.dumps(figures))


if __name__ == "__main__":
    main()
