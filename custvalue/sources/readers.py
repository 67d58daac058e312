"""Batch sources (S1, S2, S5, S6): explicit schemas, failures raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FLAT_LINE, INVOICE


def read_csv_lines(spark: SparkSession, path: str,
                   schema: T.StructType = FLAT_LINE) -> DataFrame:
    """CSV with a header row, typed by ``schema`` (no inference pass
    over the data).  Rows that do not fit the schema raise (FAILFAST)."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
                 .csv(path))


def read_nested_json(spark: SparkSession, path: str, multi_line: bool = True,
                     schema: T.StructType = INVOICE) -> DataFrame:
    """Nested invoice JSON with the canonical schema.

    ``multi_line`` reads files holding one JSON document each (e.g. an array
    of invoices); such files are parsed whole, one task per file, so the
    landing job keeps them bounded in size.  Line-delimited JSON
    (``multi_line=False``) splits freely.  Read errors raise instead of
    returning an empty result.
    """
    return (spark.read.schema(schema).option("multiLine", multi_line)
                 .option("mode", "FAILFAST").json(path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S5 re-aimed: spreadsheets are converted upstream; tables are read as
    parquet (column pruning, predicate pushdown) or CSV."""
    if fmt == "csv":
        return read_csv_lines(spark, path)
    return spark.read.format(fmt).load(path)


def write_json_array_files(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Write ``df`` as JSON-array documents (the multi-line raw-zone form).

    Rows are spread over ``ceil(rows / rows_per_file)`` documents by a hash
    of the whole row, so each document -- and the one task that parses it
    back -- stays bounded however large the input grows.  Equal rows are counted
    first and dealt out in short runs, so they spread as well.  Each document
    is its own file under ``b=<bucket>/``.
    """
    run = max(1, rows_per_file // 50)
    counted = (df.select(F.to_json(F.struct(*df.columns)).alias("j"))
                 .groupBy("j").agg(F.count(F.lit(1)).alias("c")))
    counted = counted.persist()                           # the rows are counted and written
    try:
        n = counted.agg(F.sum("c")).first()[0] or 0
        _write_documents(counted, path, max(1, -(-n // rows_per_file)), run)
    finally:
        counted.unpersist()


def _write_documents(counted: DataFrame, path: str, files: int, run: int) -> None:
    runs = counted.withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c") - 1) / run))))
    bucket = F.pmod(F.xxhash64("j", "r"), F.lit(files))
    many = F.array_repeat("j", F.least(F.lit(run).cast("bigint"), F.col("c") - F.col("r") * run).cast("int"))
    # one document per file: a multi-line reader parses a file as ONE value
    docs = (runs.withColumn("b", bucket).repartition(files, "b").groupBy("b")
              .agg(F.concat(F.lit("["), F.array_join(F.flatten(F.collect_list(many)), ","), F.lit("]"))
                   .alias("value")))
    docs.write.mode("overwrite").partitionBy("b").option("compression", "gzip").text(path)
