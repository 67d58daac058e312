"""Views of the invoice data model over the driver tables.

``invoice_lines`` (flat retail lines), ``invoices`` (nested events),
``dirty_lines`` (deterministically damaged lines) and ``score_events``
(the ranking feed) are all plain DataFrame plans over the parquet tables, so
column pruning and filter pushdown reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import datetime_text
from ..session import spread


LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

# Fixed damage rules of ``dirty_lines``, chosen by l_orderkey % 97.
DAMAGE_MODULUS = 97
DAMAGE_NULL_CUSTOMER = 0
DAMAGE_NULL_QUANTITY = 1
DAMAGE_ISO_DATE = 2
DAMAGE_BAD_DATE = 3
DAMAGE_ZERO_PRICE = 4

# The two snapshots of the ranking feed compared by ``rank_change``.
SNAPSHOT_CUTOFF = "2024-01-15 00:00:00"


def invoice_text(ts) -> "F.Column":
    """timestamp -> ``yyyy-MM-dd HH:mm:ss`` text.  The text is referenced
    several times by the cleaning expressions downstream and the optimizer
    inlines it into each reference, so it is built from cheap built-ins."""
    return datetime_text(ts, " ")


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame, resolved once per session and path
    (file listing and footer reads are not repeated for every query)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def invoice_lines(spark: SparkSession, sf_dir: str, keep_keys: bool = False,
                  by_order: bool = False, files: int | None = None) -> DataFrame:
    """Flat invoice lines = lineitem x orders x customer x nation x part.

    Quantity is negated for returned lines (l_returnflag = 'R'); the invoice
    time is the order date plus ``o_orderkey % 24`` hours.  Joins are plain
    equi-joins: the planner broadcasts the dimension sides only when their
    measured size is under ``autoBroadcastJoinThreshold`` and shuffles
    otherwise (customer and part are large at scale).

    ``by_order`` is for callers that group by invoice: orders meet their customers
    before they meet lines, so the many lines are dealt out twice only, narrow to
    their parts, then to their orders, where they stay; with ``files`` in that many partitions.
    """
    li = spread(table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_quantity", "l_returnflag"), "l_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    qty = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")) \
        .otherwise(F.col("l_quantity")).cast("int")
    ts = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    if by_order:
        placed = (o.join(c, F.col("o_custkey") == c.c_custkey)
                   .join(n, F.col("c_nationkey") == n.n_nationkey)
                   .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
        sold = li.join(p, F.col("l_partkey") == p.p_partkey).drop("p_partkey")
        if files:
            sold = sold.repartition(files, "l_orderkey")
        joined = sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        joined = (li.join(o, li.l_orderkey == o.o_orderkey)
                    .join(c, F.col("o_custkey") == c.c_custkey)
                    .join(n, F.col("c_nationkey") == n.n_nationkey)
                    .join(p, F.col("l_partkey") == p.p_partkey))
    cols = [
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        qty.alias("Quantity"),
        invoice_text(ts).alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    ]
    if keep_keys:
        cols += [F.col(k) for k in LINE_KEY]
    return joined.select(*cols)


def dirty_lines(spark: SparkSession, sf_dir: str, keep_keys: bool = False,
                by_order: bool = False, files: int | None = None) -> DataFrame:
    """``invoice_lines`` with deterministic damage by ``l_orderkey % 97``."""
    df = invoice_lines(spark, sf_dir, keep_keys=True, by_order=by_order, files=files)
    m = F.col("l_orderkey") % DAMAGE_MODULUS
    df = df.select(
        "InvoiceNo", "StockCode", "Description",
        F.when(m == DAMAGE_NULL_QUANTITY, F.lit(None).cast("int"))
         .otherwise(F.col("Quantity")).alias("Quantity"),
        F.when(m == DAMAGE_ISO_DATE, F.regexp_replace("InvoiceDate", " ", "T"))
         .when(m == DAMAGE_BAD_DATE, F.lit("n/a"))
         .otherwise(F.col("InvoiceDate")).alias("InvoiceDate"),
        F.when(m == DAMAGE_ZERO_PRICE, F.lit(0.0))
         .otherwise(F.col("UnitPrice")).alias("UnitPrice"),
        F.when(m == DAMAGE_NULL_CUSTOMER, F.lit(None).cast("string"))
         .otherwise(F.col("CustomerID")).alias("CustomerID"),
        "Country", *LINE_KEY)
    return df if keep_keys else df.drop(*LINE_KEY)


def invoices(spark: SparkSession, sf_dir: str, files: int | None = None, dirty: bool = False) -> DataFrame:
    """Nested invoices: one row per (InvoiceNo, InvoiceDate, CustomerID, Country), with ``dirty`` of
    ``dirty_lines``, with ``files`` in that many partitions.

    The number of an invoice is its order key as text, so the lines are nested where
    the join by order key left them."""
    from ..operators.nested import nest_invoices
    lines = (dirty_lines if dirty else invoice_lines)(spark, sf_dir, keep_keys=True, by_order=True, files=files)
    return nest_invoices(lines, within="l_orderkey")


def score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking feed {key, clv} from events, with its event time and order."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("value").alias("clv"),
        F.col("ts"), F.col("event_id"))
