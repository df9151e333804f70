"""Slowest stages from a Spark event log folder (as written by bench.py with
BENCH_EVENT_LOG_DIR).  Reads plain or zstd-compressed event files.

    python tools/stage_times.py <event-log-dir> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8", errors="ignore")
    else:
        with open(path, encoding="utf-8", errors="ignore") as fh:
            yield from fh


def stages(folder: str) -> list[tuple[int, int, str]]:
    out = []
    for path in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True):
        for line in _lines(path):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict) and e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out.append((si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], si["Stage Name"]))
    return sorted(out, reverse=True)


if __name__ == "__main__":
    found = stages(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    print(f"{len(found)} stages, {sum(s[0] for s in found)} ms in total")
    for ms, tasks, name in found[:top]:
        print(f"{ms:7d} ms {tasks:5d} tasks  {name[:90]}")
