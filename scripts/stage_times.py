"""Summarise a Spark event log (plain or zstd, rolling or single file): slowest stages and totals.

Usage: python scripts/stage_times.py EVENTLOG_DIR_OR_FILE [top_n]
"""

from __future__ import annotations

import io
import json
import sys
from pathlib import Path


def _lines(path: Path):
    if path.suffix == ".zstd":
        import zstandard
        with path.open("rb") as fh, zstandard.ZstdDecompressor().stream_reader(fh) as r:
            yield from io.TextIOWrapper(r, encoding="utf-8")
    else:
        with path.open(encoding="utf-8") as fh:
            yield from fh


def main() -> int:
    root = Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = sorted(p for p in (root.rglob("*") if root.is_dir() else [root])
                   if p.is_file() and (p.name.startswith("events_") or p.suffix in ("", ".zstd"))
                   and not p.name.startswith((".", "appstatus")))
    stages, jobs = {}, 0
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                stages[info["Stage ID"]] = (info.get("Completion Time", 0) - info.get("Submission Time", 0),
                                            info["Number of Tasks"], info["Stage Name"])
            elif ev == "SparkListenerJobEnd":
                jobs += 1
    total = sum(d for d, _, _ in stages.values())
    print(f"jobs={jobs} stages={len(stages)} summed_stage_ms={total}")
    for sid, (dur, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{sid:5d} {dur:7d} ms {tasks:5d} tasks  {name[:90]}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
