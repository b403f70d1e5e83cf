"""Ranks, running sums and neighbours over a whole table, by a range sort: no window gathers all rows in one task.

The table is range-partitioned and sorted; rows count on from the rows of the partitions before theirs, of which only one
row a partition meets in one place. The sorted rows are checkpointed, so that their positions can't change on a retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.graph import checkpointed

_BITS = 33  # of a row's position in its partition, as monotonically_increasing_id has them


def _sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    return checkpointed(rows.withColumn("__part", F.shiftright("__at", _BITS)))


def _started(rows: DataFrame, value: Column, start: str) -> DataFrame:
    """rows + start: the sum of ``value`` over the partitions before a row's own."""
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    parts = rows.groupBy("__part").agg(F.sum(value).alias("__sum"))
    return rows.join(parts.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias(start)), "__part")


def ranked(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """df + out: the place in the order, from 0; the order should be total."""
    rows = _started(_sorted(df, order), F.lit(1).cast("long"), "__start")
    return rows.withColumn(out, F.col("__start") + F.col("__at").bitwiseAND((1 << _BITS) - 1)).drop("__at", "__part", "__start")


def running_sum(df: DataFrame, order: list[Column], value: Column, out: str) -> DataFrame:
    """df + out: the sum of ``value`` over the rows up to this one, itself included."""
    rows = _started(_sorted(df.withColumn("__v", value), order), F.col("__v"), "__start")
    own = F.sum("__v").over(Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, F.col("__start") + F.coalesce(own, F.lit(0))).drop("__at", "__part", "__start", "__v")


def followed(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """df + out: ``value`` of the next row, null for the last one."""
    rows = _sorted(df, order)
    heads = rows.groupBy("__part").agg(F.min_by(value, "__at").alias("__head"))
    ahead = heads.select("__part", F.lead("__head").over(Window.orderBy("__part")).alias("__next"))  # a row a partition
    inside = Window.partitionBy("__part").orderBy("__at")
    last = F.row_number().over(Window.partitionBy("__part").orderBy(F.col("__at").desc())) == 1
    return rows.withColumn(out, F.lead(value).over(inside)).withColumn("__last", last).join(ahead, "__part").withColumn(out, F.when(F.col("__last"), F.col("__next")).otherwise(F.col(out))).drop("__at", "__part", "__last", "__next")
