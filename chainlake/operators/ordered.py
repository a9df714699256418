"""Running values over a whole ordered table without gathering it in one task.

Rows are dealt to slices by range of the order and written once; a slice's total is added up
over the slices before it (one row a slice), and the running value is completed within each slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written


def _sliced(rows: DataFrame, order: tuple[Column, ...]) -> DataFrame:
    return written(rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")


def _running(rows: DataFrame, order: tuple[Column, ...], total: Column, over_slices, within, name: str) -> DataFrame:
    """``name``: ``within`` joined to ``over_slices`` of the totals of all earlier slices, by the caller's functions."""
    rows = _sliced(rows, order)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_slice").agg(total.alias("_total")).select("_slice", over_slices(F.col("_total")).over(earlier).alias("_before"))
    own = Window.partitionBy("_slice").orderBy(*order)
    return rows.join(F.broadcast(before), "_slice").withColumn(name, within(own, F.col("_before"))).drop("_slice", "_before")  # a row a slice


def running_sum(rows: DataFrame, value: Column, name: str, *order: Column) -> DataFrame:
    """``name``: the sum of ``value`` up to and with each row."""
    return _running(rows.withColumn("_v", value), order, F.sum("_v"), F.sum, lambda own, before: F.coalesce(before, F.lit(0)) + F.sum("_v").over(own.rowsBetween(Window.unboundedPreceding, 0)), name).drop("_v")


def highest_before(rows: DataFrame, value: str, name: str, *order: Column) -> DataFrame:
    """``name``: the largest ``value`` of all earlier rows; null for the first."""
    return _running(rows, order, F.max(value), F.max, lambda own, before: F.greatest(before, F.max(value).over(own.rowsBetween(Window.unboundedPreceding, -1))), name)


def last_known(rows: DataFrame, value: Column, name: str, *order: Column) -> DataFrame:
    """``name``: ``value`` of the latest row up to this one where it is not null."""
    rows = rows.withColumn("_v", value)
    latest = F.max_by(F.when(F.col("_v").isNotNull(), F.col("_v")), F.when(F.col("_v").isNotNull(), F.struct(*order)))
    return _running(rows, order, latest, lambda x: F.last_value(x, ignoreNulls=True), lambda own, before: F.coalesce(F.last_value("_v", ignoreNulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0)), before), name).drop("_v")
