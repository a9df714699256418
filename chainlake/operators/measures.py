"""Storage growth and benchmark aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def growth_line(points: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares (intercept, slope); the slope is floored at 0 after the intercept was computed.

    One point or equal x: intercept 0 and slope mean(y) / mean(x). No point: zeros.
    """
    n, sx, sy = F.count(F.lit(1)), F.sum(F.col(x).cast("double")), F.sum(F.col(y).cast("double"))
    sxy, sxx = F.sum(F.col(x).cast("double") * F.col(y)), F.sum(F.col(x).cast("double") * F.col(x))
    sums = points.agg(n.alias("n"), sx.alias("sx"), sy.alias("sy"), sxy.alias("sxy"), sxx.alias("sxx"))
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), spread)
    flat = F.coalesce(F.try_divide(F.col("sy"), F.col("sx")), F.lit(0.0))
    line = F.when(spread > 0, F.struct((F.try_divide(F.col("sy") - slope * F.col("sx"), F.col("n"))).alias("intercept"), F.greatest(slope, F.lit(0.0)).alias("slope"))).otherwise(F.struct(F.lit(0.0).alias("intercept"), flat.alias("slope")))
    return sums.select("n", line.alias("line")).select("n", "line.*")


def project(line: DataFrame, at: int) -> Column:
    return F.greatest(line["intercept"] + line["slope"] * at, F.lit(0.0)).cast("long")


def nearest_rank(rows: DataFrame, group: str, value: str, quantiles: tuple[tuple[str, float], ...] = (("p50", 0.5), ("p99", 0.99))) -> DataFrame:
    """n, the value at rank round((n - 1) * q), the largest and the sum, by group.

    An approximate percentile, whose error in rank is bounded, brackets each value; only the
    rows within a bracket are ranked, so no task sorts a whole group.
    """
    error, wide = 1e-4, 1e-3
    around = [F.percentile_approx(value, [max(q - wide, 0.0), min(q + wide, 1.0)], int(1 / error)).alias(f"_{name}") for name, q in quantiles]
    known = rows.filter(F.col(value).isNotNull())
    sums = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("largest"), F.sum(value).alias("total"), *around)
    near = known.select(F.col(group).alias("_group"), F.col(value).alias("_value")).join(sums, F.col("_group").eqNullSafe(F.col(group)))
    found = sums.select(group, "n", "largest", "total")
    for name, q in quantiles:
        low, high = F.col(f"_{name}")[0], F.col(f"_{name}")[1]
        below = near.groupBy(group).agg(F.count_if(F.col("_value") < low).alias("_below"))
        inside = near.filter(F.col("_value").between(low, high)).withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_value")) - 1)
        picked = inside.join(below.withColumnRenamed(group, "_of"), F.col(group).eqNullSafe(F.col("_of"))).filter(F.col("_r") + F.col("_below") == F.floor((F.col("n") - 1) * q + 0.5))
        found = found.join(picked.select(F.col(group).alias("_of"), F.col("_value").alias(name)), F.col(group).eqNullSafe(F.col("_of")), "left").drop("_of")
    return found.select(group, "n", *[name for name, _ in quantiles], "largest", "total")


def latency(rows: DataFrame, value: str) -> dict:
    """n, p50, p99, largest and total of all rows; zeros without any."""
    row = nearest_rank(rows.withColumn("_all", F.lit(0)), "_all", value).first()
    return {k: row[k] if row else 0 for k in ("n", "p50", "p99", "largest", "total")}


def trials(rows: DataFrame, stage: str, seconds: str) -> DataFrame:
    """The least, the median (of an even number: the mean of the middle two) and the largest of each stage's trials."""
    return rows.groupBy(F.col(stage).alias("stage")).agg(F.min(seconds).alias("low"), F.median(seconds).alias("mid"), F.max(seconds).alias("high"))


def stalls(lines: DataFrame, text: str) -> DataFrame:
    """The lines of a report that speak of stalls."""
    return lines.filter(F.lower(F.col(text)).contains("stall"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def within_budget(rows: DataFrame, cost: Column, budget: int, *newest_first: Column) -> DataFrame:
    """The newest rows whose costs together stay within a budget; what an eviction of the oldest leaves."""
    used = ordered.running_sum(rows, cost, "_used", *newest_first)
    return used.filter(F.col("_used") <= budget).drop("_used")


def carried_sections(lines: DataFrame, line_no: str, text: str) -> DataFrame:
    """(section, height, bytes) of "height bytes" lines below their "network X" line; the rest is passed over."""
    name = F.when(F.col(text).rlike(r"^\s*network\s+\S+"), F.regexp_extract(text, r"^\s*network\s+(\S+)", 1))
    found = ordered.last_known(lines, name, "section", F.col(line_no)).filter(F.col(text).rlike(r"^\s*\d+\s+\d+\s*$"))
    return found.select("section", F.regexp_extract(text, r"(\d+)", 1).cast("long").alias("height"), F.regexp_extract(text, r"\d+\s+(\d+)", 1).cast("long").alias("bytes"))


def monotone(rows: DataFrame, value: str, *order: str) -> DataFrame:
    """Rows whose value exceeds all earlier ones."""
    topped = ordered.highest_before(rows, value, "_top", *map(F.col, order))
    return topped.filter(F.col("_top").isNull() | (F.col(value) > F.col("_top"))).drop("_top")
