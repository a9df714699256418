"""Storage guard: footprint, growth history in a text file, projection, and the check before a run."""

from __future__ import annotations

import math
import os
import shutil
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import measures

GIB = 1 << 30
LEAST_FREE = 10 * GIB


class NoSpace(RuntimeError):
    """The projected size leaves too little free space."""


def folder_bytes(folder: str) -> int:
    """All files below a folder; links are not followed, a missing folder has none."""
    return sum(os.lstat(f"{at}/{name}").st_size for at, _, names in os.walk(folder) for name in names if not os.path.islink(f"{at}/{name}"))


def free_bytes(folder: str) -> int:
    """Free space where the folder is or would be."""
    path = Path(folder).absolute()
    while not path.exists():
        path = path.parent
    return shutil.disk_usage(path).free


def history(spark: SparkSession, file: str, network: str) -> DataFrame:
    """(height, bytes) of a network's section, by height; comments, blank lines and lines of other forms are passed over."""
    text = spark.read.text(file, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    plain = lines.withColumn("line", F.regexp_replace("line", r"#.*$", ""))
    return measures.carried_sections(plain, "line_no", "line").filter(F.col("section") == network).select("height", "bytes").orderBy("height")


def append_point(file: str, network: str, height: int, size: int) -> bool:
    """Add "height bytes" to a network's section, which is made if missing; False if the height is there."""
    path = Path(file)
    lines = path.read_text().splitlines() if path.exists() else ["# height bytes, by network"]
    section, last = None, None
    for i, line in enumerate(lines):
        words = line.split("#")[0].split()
        if words[:1] == ["network"] and len(words) == 2:
            section = words[1]
        if section == network and words:
            last = i
            if words[0] == str(height) and len(words) == 2:
                return False
    point = f"{height} {size}"
    lines[len(lines) if last is None else last + 1 :] = ([f"network {network}", point] if last is None else [point]) + ([] if last is None else lines[last + 1 :])
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return True


class Recorder:
    """Writes a point at each multiple of ``step`` that is higher than the last one."""

    def __init__(self, file: str, network: str, folders: list[str], step: int = 100_000, last: int = 0):
        self.file, self.network, self.folders, self.step, self.last = file, network, folders, step, last

    def on_block(self, height: int) -> bool:
        if not height or height % self.step or height <= self.last:
            return False
        self.last = height
        return append_point(self.file, self.network, height, sum(map(folder_bytes, self.folders)))


def due(heights: DataFrame, step: int) -> DataFrame:
    """The heights, in the order of ``at``, at which a recorder would write."""
    return measures.monotone(heights.filter((F.col("height") % step == 0) & (F.col("height") > 0)), "height", "at")


@dataclass(frozen=True)
class Preflight:
    current: int
    projected: int
    additional: int
    free: int
    free_at_end: int
    missing_gib: int

    def text(self) -> str:
        return f"now {self.current / GIB:.2f} GiB, at the tip {self.projected / GIB:.2f} GiB, free then {self.free_at_end / GIB:.2f} GiB"


def preflight(points: DataFrame, tip: int, current: int, free: int, least_free: int = LEAST_FREE) -> Preflight:
    """What the growth so far leaves free at the tip. Raises NoSpace if that is too little and there is a history."""
    line = measures.growth_line(points, "height", "bytes")
    row = line.select("n", measures.project(line, tip).alias("projected")).first()
    additional = max(0, row["projected"] - current)
    left = max(0, free - additional)
    found = Preflight(current, row["projected"], additional, free, left, math.ceil(max(0, additional + least_free - free) / GIB))
    if row["n"] and left < least_free:
        raise NoSpace(f"{found.text()}; {found.missing_gib} GiB are missing")
    return found
