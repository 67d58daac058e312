"""Distributed global ordering helpers.

A global position (``row_number`` over the whole data set) written as an
unpartitioned window pulls every row into one task.  Here the data is range
partitioned on the order key, sorted within partitions, and each row's
position is its partition's offset (a prefix sum over at most
``partitions`` counts) plus its index inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_positions(df: DataFrame, order: list[Column | str], pos_col: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """Add a 0-based position in the total order ``order`` (must be a total
    order, i.e. end with a unique key, for the result to be deterministic).

    The range-partitioned, sorted frame is checkpointed to the shared
    checkpoint folder before positions are derived: the counts and the rows
    then come from the same materialised partitions even if an executor is
    lost and stages are recomputed.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(df.columns)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # at most n rows: a single-partition window and a broadcast are bounded
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .select(*cols, (F.col("_off") + local).alias(pos_col)))
