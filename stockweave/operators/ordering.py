"""Running totals along a global order without moving all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def running_total(df: DataFrame, order: list[str], weight: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over all rows up to and including this one.

    Rows are range partitioned on ``order`` (unique per row) and written, which
    fixes their partition. The single-task window sees one row per partition;
    that table is joined back, and rows are totalled inside each partition.
    """
    placed = materialize(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    before = (
        placed.groupBy("_part")
        .agg(F.sum(weight).alias("_sum"))
        .withColumn(
            "_before",
            F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_part", F.coalesce(F.col("_before"), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy("_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per range partition, at most spark.sql.shuffle.partitions of them.
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + F.sum(weight).over(inside))
        .drop("_part", "_before")
    )
