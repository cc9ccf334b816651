"""Summarise a Spark event log per job description (written by ``bench.py`` with ``BENCH_EVENT_LOG=1``).

usage: python tools/stage_report.py <event-log file or folder>

For every job description (bench sets one per query run) prints the number of
jobs, stages and tasks, input bytes read, shuffle bytes written and read, and
bytes spilled -- the numbers that decide how a plan scales. Reads the JSON
event log only; no Spark UI or REST endpoint is used.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event-log files under ``path`` (Spark 4 writes rolling logs as folders of ``events_*`` files)."""
    if not os.path.isdir(path):
        return [path]
    found = []
    for root, _, names in os.walk(path):
        for f in sorted(names):
            if not f.startswith((".", "appstatus")):
                found.append(os.path.join(root, f))
    def order(p: str):
        name = os.path.basename(p)
        n = name.split("_")[1] if name.startswith("events_") else "0"
        return (os.path.dirname(p), int(n) if n.isdigit() else 0, name)

    return sorted(found, key=order)


def _lines(path: str):
    """Text lines of an event-log file (plain or zstd-compressed, Spark 4's default)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path, encoding="utf-8") as fh:
        yield from fh


def summarise(path: str) -> dict[str, dict[str, int]]:
    stage_desc: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for f in _files(path):
        for line in _lines(f):
            if True:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or "(none)"
                    out[desc]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    desc = stage_desc.get(info["Stage ID"], "(none)")
                    out[desc]["stages"] += 1
                    out[desc]["tasks"] += info.get("Number of Tasks", 0)
                elif kind == "SparkListenerTaskEnd":
                    desc = stage_desc.get(ev.get("Stage ID"), "(none)")
                    m = ev.get("Task Metrics") or {}
                    out[desc]["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    sw = m.get("Shuffle Write Metrics") or {}
                    out[desc]["shuffle_write_bytes"] += sw.get("Shuffle Bytes Written", 0)
                    sr = m.get("Shuffle Read Metrics") or {}
                    out[desc]["shuffle_read_bytes"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    out[desc]["spill_bytes"] += m.get("Disk Bytes Spilled", 0)
    return out


def main() -> None:
    data = summarise(sys.argv[1])
    cols = ["jobs", "stages", "tasks", "input_bytes", "shuffle_write_bytes", "shuffle_read_bytes", "spill_bytes"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for desc in sorted(data):
        row = data[desc]
        print(f"| {desc} | " + " | ".join(f"{row.get(c, 0):,}" for c in cols) + " |")


if __name__ == "__main__":
    main()
