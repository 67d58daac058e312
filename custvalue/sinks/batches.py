"""Micro-batch folders: plain Parquet under ``path/batch_id=N``.

``foreachBatch`` overwrites the folder of its batch id, so a replayed batch gives the
same folder.  Batches run one after the other: when batch N runs, all folders below N
are complete, and what a failed attempt left in N is not read.  A table of one row per
key is the last batch's row of every key, found on read by one mergeable aggregation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the ``batch_id=N`` folders that were written completely, ascending."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath() for st in fs.listStatus(root)]
    return sorted(int(x.getName()[9:]) for x in names
                  if re.fullmatch(r"batch_id=\d+", x.getName()) and fs.exists(jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")))


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All complete batches (below ``before``) with their ``batch_id``; None without any."""
    ids = [b for b in finished_batches(spark, path) if before is None or b < before]
    if not ids:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in ids])


def latest_rows(batches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: that of the last batch which has it."""
    rest = [c for c in batches.columns if c not in (*keys, "batch_id")]
    last = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("row"))
    return last.select(*keys, "row.*")


def compact(spark: SparkSession, path: str, out_path: str, merge) -> int | None:
    """Maintenance job: ``merge`` all complete batches of ``path`` into the one batch folder of
    their last id below ``out_path``.  A stream that starts with ``out_path`` goes on from there."""
    ids = finished_batches(spark, path)
    if not ids:
        return None
    write_batch(merge(read_batches(spark, path)).drop("batch_id"), out_path, ids[-1])
    return ids[-1]
