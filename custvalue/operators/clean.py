"""Projection, predicate and cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (DATE_FORMAT, WEEKEND_DAYS, epoch_seconds,
                                 line_revenue, money_ok, parse_invoice_ts, to_int_truncating,
                                 weekend_flag)
from ..schemas import LINE_COLUMNS

# Fixed values (they must equal the source system's):
# per-column defaults used before validation (text -> '', numbers -> 0),
FILL_DEFAULTS = {
    "CustomerID": "", "InvoiceDate": "", "Country": "", "StockCode": "",
    "Description": "", "Quantity": 0, "UnitPrice": 0.0,
}

# and the required columns of a raw retail table, in the order they are checked.
REQUIRED_COLUMNS = ["InvoiceNo", "InvoiceDate", "CustomerID", "Country", "StockCode",
                    "Description", "Quantity", "UnitPrice"]

TYPED_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice",
                 "CustomerID", "Country", "invoice_ts"]
CLEAN_COLUMNS = [*TYPED_COLUMNS, "invoice_epoch", "hour", "dayofweek", "weekend", "Revenue"]


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with null InvoiceDate, Quantity or UnitPrice."""
    return df.dropna(subset=["InvoiceDate", "Quantity", "UnitPrice"])


def required_rows(df: DataFrame, required=tuple(LINE_COLUMNS)) -> DataFrame:
    """Drop rows with a null in any required column."""
    return df.dropna(subset=list(required))


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill nulls with per-column defaults (only columns present)."""
    d = {k: v for k, v in (defaults or FILL_DEFAULTS).items() if k in df.columns}
    return df.fillna(d)


def check_required_columns(df: DataFrame, required=tuple(REQUIRED_COLUMNS)) -> DataFrame:
    """Trim column names; raise KeyError naming the first missing column."""
    df = df.toDF(*[c.strip() for c in df.columns])
    for c in required:
        if c not in df.columns:
            raise KeyError(f"Missing required column: {c}")
    return df


def time_parts(df: DataFrame, ts_col: str = "invoice_ts",
               weekend_days=WEEKEND_DAYS) -> DataFrame:
    """Hour, dayofweek (1 = Sunday .. 7 = Saturday), weekend flag."""
    return (df.withColumn("hour", F.hour(ts_col))
              .withColumn("dayofweek", F.dayofweek(ts_col))
              .withColumn("weekend", weekend_flag(F.dayofweek(ts_col), weekend_days)))


def clean_lines(df: DataFrame, weekend_days=WEEKEND_DAYS,
                drop_unparsed: bool = True) -> DataFrame:
    """C18 = C1 + C7 + C8 + C10..C13 in one projection.

    Quantity is truncated to int, UnitPrice kept as double, the date parsed
    (ISO ``T`` accepted), and Revenue = Quantity x UnitPrice.  Rows whose date
    or numbers do not parse, or whose price is out of range, are dropped
    (``clean_counts`` counts them, ``unclean_lines`` returns them);
    ``drop_unparsed=False`` keeps them with null time parts and null revenue,
    as the source system did.  Further columns pass through.
    """
    ts = parse_invoice_ts("InvoiceDate")
    qty = to_int_truncating("Quantity")
    price = F.col("UnitPrice").try_cast("double")
    out = drop_incomplete(df).select(
        "InvoiceNo", "StockCode", "Description",
        qty.alias("Quantity"), price.alias("UnitPrice"),
        "CustomerID", "Country", ts.alias("invoice_ts"),
        *[c for c in df.columns if c not in (*CLEAN_COLUMNS, "InvoiceDate")])
    if drop_unparsed:
        out = out.filter(F.col("invoice_ts").isNotNull() & F.col("Quantity").isNotNull()
                         & money_ok("Quantity", "UnitPrice"))
    return line_parts(out, weekend_days)


def line_parts(typed: DataFrame, weekend_days=WEEKEND_DAYS) -> DataFrame:
    """The columns of ``clean_lines`` that follow from a line's typed time, quantity and price."""
    out = time_parts(typed, "invoice_ts", weekend_days)
    return out.select(
        *[c for c in out.columns if c not in ("hour", "dayofweek", "weekend")],
        epoch_seconds("invoice_ts").alias("invoice_epoch"),
        "hour", "dayofweek", "weekend",
        F.when(money_ok("Quantity", "UnitPrice"), line_revenue()).alias("Revenue"))


def unclean_reason() -> Column:
    """Why ``clean_lines`` drops a row (null when it does not)."""
    return (F.when(F.col("InvoiceDate").isNull() | F.col("Quantity").isNull() | F.col("UnitPrice").isNull(), "incomplete")
               .when(parse_invoice_ts("InvoiceDate").isNull(), "invalid date")
               .when(to_int_truncating("Quantity").isNull(), "invalid quantity")
               .when(~money_ok(to_int_truncating("Quantity"), F.col("UnitPrice").try_cast("double")), "invalid price"))


def unclean_lines(df: DataFrame) -> DataFrame:
    """Quarantine of ``clean_lines``: the rows it drops, unchanged, with a reason."""
    return df.withColumn("reason", unclean_reason()).filter(F.col("reason").isNotNull())


def normalise_lines(df: DataFrame) -> DataFrame:
    """Required rows, typed str/int/double, date re-formatted as text."""
    df = required_rows(df)
    return df.select(
        F.col("InvoiceNo").cast("string").alias("InvoiceNo"),
        F.col("StockCode").cast("string").alias("StockCode"),
        F.col("Description").cast("string").alias("Description"),
        to_int_truncating("Quantity").alias("Quantity"),
        F.date_format(parse_invoice_ts("InvoiceDate"), DATE_FORMAT).alias("InvoiceDate"),
        F.col("UnitPrice").try_cast("double").alias("UnitPrice"),
        F.col("CustomerID").cast("string").alias("CustomerID"),
        F.col("Country").cast("string").alias("Country"))


def notebook_clean(df: DataFrame) -> DataFrame:
    """C3 + C4: known customer, positive price and quantity."""
    return (df.dropna(subset=["CustomerID"])
              .filter((F.col("UnitPrice") > 0) & (F.col("Quantity") > 0)))


def dedup_customer(df: DataFrame, key: str = "CustomerID") -> DataFrame:
    """C14: one line per customer, the smallest by a total order of all columns.

    Written as ``min(struct(all columns))`` grouped by key rather than a
    window: the aggregate combines map-side, so a customer holding a third
    of all lines still ships one row per map partition, and the survivor is
    the same under any partitioning.
    """
    rest = [c for c in df.columns if c != key]
    return (df.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.min(F.struct(*rest)).alias("_s"))
              .select(key, *[F.col(f"_s.{c}").alias(c) for c in rest]))


def epoch_roundtrip(df: DataFrame) -> DataFrame:
    """Timestamp -> epoch seconds -> timestamp and ISO text."""
    from ..functions.columns import datetime_text, from_epoch_seconds
    return df.select(
        "InvoiceNo", "StockCode", "invoice_epoch",
        from_epoch_seconds("invoice_epoch").alias("restored_ts"),
        datetime_text(from_epoch_seconds("invoice_epoch"), "T").alias("iso_text"))


def drop_helpers(df: DataFrame, helpers=("invoice_epoch", "hour", "dayofweek",
                                          "weekend")) -> DataFrame:
    """Drop helper columns before a sink."""
    return df.drop(*helpers)
