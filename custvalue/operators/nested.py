"""Nested / JSON operators (N1-N6) and validated ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INVOICE, ITEM

INVOICE_KEYS = ["InvoiceNo", "InvoiceDate", "CustomerID", "Country"]
CORRUPT_COL = "_corrupt_record"


def parse_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
               keep: tuple = ()) -> DataFrame:
    """N1 + N2: (binary or string) JSON -> typed columns.

    A value that does not fit its field type gives null in that field.  Every value is
    parsed once, whatever is done with the columns.
    """
    text = F.col(value_col).cast("string")
    # a generated row: the optimizer copies a plain from_json into every filter and projection over it
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def explode_items(invoices: DataFrame, position: str | None = None) -> DataFrame:
    """One row per item; invoices with null or empty Items vanish.

    ``position`` names a further column with the item's place in its invoice."""
    if position is None:
        return invoices.select(*INVOICE_KEYS, F.inline("Items"))
    return (invoices.select(*INVOICE_KEYS, F.posexplode("Items").alias(position, "_item"))
                    .select(*INVOICE_KEYS, "_item.*", position))


def nest_invoices(lines: DataFrame, max_items: int | None = None, within: str | None = None) -> DataFrame:
    """Lines -> one nested invoice per (InvoiceNo, InvoiceDate, CustomerID, Country).

    Items are sorted so the message is deterministic.  An invoice is one message
    whatever its size, built by one aggregation.  ``within`` names a column that has one
    value per InvoiceNo and by which the lines are dealt out already.

    A caller whose messages must stay small gives ``max_items``: then no message
    holds more than about that many items, an invoice above it becomes several
    with the same invoice columns, numbered by a ``Part`` column (0 for the
    others), and exploding them gives back exactly its lines.  Invoice sizes are
    counted first (combined map-side) and joined back, salted.  Equal items are
    counted before they are dealt out, in runs of at most ``max_items``, so that
    neither a hot invoice nor a hot item meets in one task.
    """
    names = [f.name for f in ITEM.fields]
    item = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ITEM.fields])
    if max_items is None:
        return (lines.groupBy(*INVOICE_KEYS, *([within] if within else []))
                     .agg(F.sort_array(F.collect_list(item)).alias("Items"))
                     .select(*INVOICE_KEYS, "Items"))
    bound = max_items
    sizes = lines.groupBy(*INVOICE_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    from .scoring import hot_keys_of_counts, salted_left_join
    # invoice keys may be null (e.g. a missing customer): join on an exact,
    # never-null text (a null is left out of the JSON)
    kcol = F.to_json(F.struct(*INVOICE_KEYS))
    sizes = sizes.select(kcol.alias("_k"), F.col("_n").alias("_size"))
    sized = salted_left_join(lines.withColumn("_k", kcol), sizes, "_k", hot_keys_of_counts(sizes, "_k", "_size")).withColumnRenamed("_size", "_n")
    runs = (sized.groupBy(*INVOICE_KEYS, "_n", *names).agg(F.count(F.lit(1)).alias("_c"))
                 .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                          F.floor((F.col("_c") - 1) / bound)))))
    parts = F.ceil(F.col("_n") / F.lit(float(bound))).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64(*names, "_run"), parts)).otherwise(F.lit(0))
    many = F.array_repeat(item, F.least(F.lit(bound).cast("bigint"), F.col("_c") - F.col("_run") * bound).cast("int"))
    return (runs.withColumn("Part", part.cast("int")).groupBy(*INVOICE_KEYS, "Part")
                .agg(F.sort_array(F.flatten(F.collect_list(many))).alias("Items")))


def to_json_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Kafka-shaped frame: optional key plus the JSON of the whole row."""
    cols = [F.col(key_col).cast("string").alias("key")] if key_col else []
    return df.select(*cols, F.to_json(F.struct(*df.columns)).alias("value"))


def _item_ok(x):
    return (x["StockCode"].isNotNull() & x["Description"].isNotNull()
            & x["Quantity"].isNotNull() & x["UnitPrice"].isNotNull())


def ingest_invoices(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse invoice JSON and mark each record valid or not.

    Every field of the invoice contract is required: a record is valid when
    it parses, all top-level fields are present and typed, Items is a
    non-empty list and every item has all four fields.  Returns the parsed
    columns plus ``is_valid`` and the raw text for quarantine.
    """
    schema = T.StructType(INVOICE.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = raw.select(
        F.col(value_col).cast("string").alias("raw"),
        F.from_json(F.col(value_col).cast("string"), schema,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
        .alias("d")).select("raw", "d.*")
    ok = (F.col(CORRUPT_COL).isNull()
          & F.col("InvoiceNo").isNotNull() & F.col("InvoiceDate").isNotNull()
          & F.col("CustomerID").isNotNull() & F.col("Country").isNotNull()
          & F.col("Items").isNotNull() & (F.size("Items") > 0)
          & F.forall("Items", _item_ok))
    return parsed.withColumn("is_valid", F.coalesce(ok, F.lit(False)))


def ingest_reason():
    """Why a record of ``ingest_invoices`` is not valid (null when it is)."""
    return F.when(~F.col("is_valid"),
                  F.when(F.col(CORRUPT_COL).isNotNull(), "unparseable")
                   .when(F.col("InvoiceNo").isNull(), "missing InvoiceNo")
                   .when(F.col("CustomerID").isNull(), "missing CustomerID")
                   .when(F.col("InvoiceDate").isNull(), "missing InvoiceDate")
                   .when(F.col("Country").isNull(), "missing Country")
                   .when(F.col("Items").isNull() | (F.size("Items") == 0), "no items")
                   .otherwise("invalid item"))


def split_ingest(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid invoices, quarantine rows with the raw text and a reason)."""
    marked = ingest_invoices(raw, value_col)
    valid = marked.filter("is_valid").select(*INVOICE.fieldNames())
    quarantine = marked.filter(~F.col("is_valid")).select("InvoiceNo", "raw", ingest_reason().alias("reason"))
    return valid, quarantine
