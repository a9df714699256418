"""What the operating system says of this process, for reports of a run."""

from __future__ import annotations

import os
import resource
import time


def sample() -> dict:
    """CPU seconds, resident and peak memory in KB, free memory of the machine in KB (None where /proc is missing)."""
    use = resource.getrusage(resource.RUSAGE_SELF)
    return {"at": time.time(), "cpu_s": use.ru_utime + use.ru_stime, "rss_kb": _field("/proc/self/status", "VmRSS"), "peak_rss_kb": use.ru_maxrss, "free_kb": _field("/proc/meminfo", "MemAvailable"), "cpus": os.cpu_count()}


def _field(file: str, name: str) -> int | None:
    try:
        with open(file) as lines:
            return next((int(x.split()[1]) for x in lines if x.startswith(f"{name}:")), None)
    except OSError:
        return None


def cpu_share(before: dict, after: dict) -> float | None:
    """CPU seconds per second and CPU between two samples."""
    wall = after["at"] - before["at"]
    return (after["cpu_s"] - before["cpu_s"]) / wall / after["cpus"] if wall > 0 and after["cpus"] else None
