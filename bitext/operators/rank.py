"""Global ranks and running totals without a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_table


def global_rank(df: DataFrame, *order, rank_col: str = "rank", offset: int = 0) -> DataFrame:
    """``df`` with ``rank_col``: 1-based position in ``order`` plus ``offset``.

    A range sort by all order columns deals even equal leading values to all tasks.
    The sorted rows are written as Parquet with their partition and the index in it;
    a rank is that index plus the sizes of the partitions before, one number per
    partition. Eager. Rows that agree in all order columns are ranked arbitrarily.
    """
    placed = _in_order(df, order)
    index = F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)
    return _after_parts(placed, F.count(F.lit(1))).withColumn(
        rank_col, (F.col("_before") + index + 1 + offset).cast("long")).drop("_part", "_at", "_before")


def running_total(df: DataFrame, value: str, *order, total_col: str = "before") -> DataFrame:
    """``df`` with ``total_col``: the sum of ``value`` over the rows before in ``order``.

    Summed inside each written range and carried over by one number per range. Eager.
    """
    placed = _in_order(df, order)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return _after_parts(placed, F.sum(value)).withColumn(
        total_col, (F.col("_before") + F.col("_inside")).cast("long")).drop("_part", "_at", "_before", "_inside")


def _in_order(df: DataFrame, order) -> DataFrame:
    return written_table(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"),
                                                   F.monotonically_increasing_id().alias("_at")), "ordered")


def _after_parts(placed: DataFrame, size) -> DataFrame:
    """``placed`` with ``_before``: the sizes of the ranges before a row's range, which
    are as many rows as the sort had tasks."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(size.alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.join(F.broadcast(sizes.select("_part", "_before")), "_part")
