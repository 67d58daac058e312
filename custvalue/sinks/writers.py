"""Sinks (K1-K10): relational, wide-column, files, Kafka-shaped, console.

Connector options live in thin functions; the data work (row keys, JSON
values, latest-per-key) is done by DataFrame operators before the write, on
the executors.  No row is written from a driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, truncate: bool = True,
               batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """K1/K2: JDBC write.  ``mode="overwrite"`` with ``truncate`` keeps the
    table's DDL (constraints, types) and only replaces rows.  Writes run on
    the executors, ``num_partitions`` caps concurrent connections."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if mode == "overwrite" and truncate:
        props["truncate"] = "true"
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                partition_by: list[str] | None = None, options: dict | None = None) -> None:
    """K4 generic: any DataFrame writer format (parquet, json, csv, or a
    catalog-backed wide-column connector when its jar is present)."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """K9: batch write of a ``key``/``value`` frame to Kafka (needs the
    spark-sql-kafka package on the classpath)."""
    (df.select(*[c for c in ("key", "value") if c in df.columns])
       .write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())


def kafka_stream_writer(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """K9 streaming form: returns the configured ``DataStreamWriter``."""
    return (df.select(*[c for c in ("key", "value") if c in df.columns])
              .writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", topic).option("checkpointLocation", checkpoint))


def console_writer(df: DataFrame, truncate: bool = False, rows: int = 20):
    """K7: console sink (append) for a streaming frame."""
    return (df.writeStream.format("console").outputMode("append")
              .option("truncate", str(truncate).lower()).option("numRows", rows))


def csv_landing_writer(df: DataFrame, path: str, checkpoint: str,
                       columns: list[str] | None = None):
    """K6: append raw rows (optionally a fixed projection) as CSV files."""
    src = df.select(*columns) if columns else df
    return (src.writeStream.format("csv").option("header", "true").option("path", path)
               .option("checkpointLocation", checkpoint).outputMode("append"))


def json_landing_writer(df: DataFrame, path: str, checkpoint: str,
                        partition_by: list[str] | None = None, fmt: str = "json"):
    """K5: append raw events to the landing zone (one file set per batch,
    exactly-once through the checkpoint; no read-modify-write of a file)."""
    w = (df.writeStream.format(fmt).option("path", path)
           .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.partitionBy(*partition_by) if partition_by else w


def with_ingest_date(df: DataFrame, ts_col: str = "invoice_ts") -> DataFrame:
    """Partition column for the landing zone (prunes reads by day)."""
    return df.withColumn("ingest_date", F.to_date(ts_col))
