"""Numbering of rows in a total order without a single-task window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from imagelab.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_global_index(df: DataFrame, order_by: Sequence[Column | str], alias: str = "idx") -> DataFrame:
    """Add 1, 2, 3, ... in the given order, which should be a total one.

    A distributed sort puts every row at its place inside a range partition; the only thing
    summed up over all rows is one count per partition. Partitions are split by the order
    itself, so one frequent leading value does not end up in one task.
    """
    tagged = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    ordered = materialise(tagged, "ordered").withColumn("_part", F.shiftright("_at", _ROW_BITS))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    in_part = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row per sort partition, so at most spark.sql.shuffle.partitions rows are broadcast
    return ordered.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + in_part + 1).alias(alias)
    )


def with_running_total(df: DataFrame, order_by: Sequence[Column | str], value: str, alias: str) -> DataFrame:
    """Add the sum of `value` over this and all earlier rows in the given order.

    Totals run inside the range partitions of a distributed sort, and start from the totals of the
    partitions before, one row each.
    """
    tagged = df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id())
    ordered = materialise(tagged, "ordered").withColumn("_part", F.shiftright("_at", _ROW_BITS))
    sums = ordered.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = ordered.withColumn("_inside", F.sum(value).over(inside))
    # one row per sort partition, so at most spark.sql.shuffle.partitions rows are broadcast
    return summed.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_inside")).alias(alias))
