"""Canonical schemas (one per abstraction; explicit, never inferred)."""

from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("UnitPrice", T.DoubleType()),
])

# Nested invoice event (one message = one invoice with its items).
INVOICE = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Items", T.ArrayType(ITEM)),
])

# Flat line item, as raw text tables and flat messages carry it.
LINE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity",
                "InvoiceDate", "UnitPrice", "CustomerID", "Country"]

FLAT_LINE = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

# Ranking message on the prediction feed.
RANK_MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("clv", T.DoubleType()),
])

# The eleven model inputs, in model order.
FEATURE_COLUMNS = [
    "total_revenue", "recency", "frequency", "t", "time_between",
    "avg_basket_value", "avg_basket_size", "num_returns",
    "purchase_hour_med", "purchase_dow_med", "purchase_weekend_prop",
]
