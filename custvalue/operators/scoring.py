"""Scoring and scored-line operators (U1, U2, J5, C15, K4 key building)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import datetime_text, from_epoch_seconds

# Fixed linear value formula used when no fitted model is given:
# CLV = sum(weight * feature), evaluated left to right in this order.
SCORE_WEIGHTS = [
    ("total_revenue", 0.8),
    ("frequency", 2.5),
    ("recency", 0.05),
    ("t", -0.01),
    ("avg_basket_value", 0.3),
    ("num_returns", -5.0),
    ("purchase_weekend_prop", 10.0),
]

# Cells of the wide-column row (family ``cf``), written as text.
KV_CELLS = ["Quantity", "UnitPrice", "InvoiceDate", "hour", "dayofweek", "weekend",
            "Revenue", "CLV_Prediction"]


def linear_score(weights=SCORE_WEIGHTS) -> Column:
    expr = None
    for name, w in weights:
        term = F.lit(float(w)) * F.col(name).cast("double")
        expr = term if expr is None else expr + term
    return expr


def score_features(features: DataFrame, model=None, key: str = "CustomerID",
                   out_col: str = "CLV_Prediction") -> DataFrame:
    """One score per customer, computed on the executors.

    ``model`` may be a fitted ``pyspark.ml`` model (``transform`` is used,
    its ``prediction`` column renamed); without one the fixed linear formula
    applies, which keeps the result checkable in SQL.
    """
    if model is None:
        return features.select(key, linear_score().alias(out_col))
    from .model import known_features
    return model.transform(known_features(features)).select(key, F.col("prediction").alias(out_col))


# ---- U1: a model from elsewhere ------------------------------------------------

MODEL_BYTES = 64 << 20       # a model file is broadcast; a larger one is refused


def linear_file(data: bytes) -> Callable[[np.ndarray], np.ndarray]:
    """Loader of a coefficient file: JSON ``{"intercept": x, "coefficients": [...]}`` in feature order."""
    spec = json.loads(data)
    w, b = np.array(spec["coefficients"], float), float(spec.get("intercept", 0.0))

    def predict(x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), b)
        for i, v in enumerate(w):                         # left to right, as the formula in SQL
            out = out + v * x[:, i]
        return out

    return predict


_LOADED: dict = {}                                        # one entry per Python worker


def _loaded(loader: Callable, data: bytes) -> Callable:
    key = (loader.__module__, loader.__qualname__, hashlib.sha256(data).hexdigest())
    if _LOADED.get("key") != key:
        _LOADED.update(key=key, predict=loader(data))
    return _LOADED["predict"]


def score_with_file(features: DataFrame, model_path: str, feature_cols: list[str],
                    loader: Callable[[bytes], Callable] = linear_file, key: str = "CustomerID",
                    out_col: str = "CLV_Prediction") -> DataFrame:
    """Scores of a model that Spark does not know.

    ``loader`` turns the bytes of the file (or folder of text parts) at ``model_path`` into a function from a matrix of
    ``feature_cols`` to one value per row.  The file is read through Spark's file systems, broadcast
    (at most ``MODEL_BYTES``), and loaded once per Python worker; rows go through it in Arrow batches.
    Missing features count as 0.
    """
    from .model import known_features
    spark = features.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(model_path)
    size = files.agg(F.sum("length")).first()[0] or 0
    if not 0 < size <= MODEL_BYTES:
        raise ValueError(f"model file of {size} bytes at {model_path}")
    data = spark.sparkContext.broadcast(b"".join(bytes(r["content"]) for r in files.orderBy("path").collect()))

    @F.arrow_udf("double")
    def predict(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        model = _loaded(loader, data.value)
        for cols in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in cols])
            yield pa.array(model(x), pa.float64())

    ready = known_features(features, feature_cols).select(key, *[F.col(c).cast("double").alias(c) for c in feature_cols])
    return ready.select(key, predict(*feature_cols).alias(out_col))


PIECES = 4                 # pieces that a task's fair share of the lines is cut into
SKETCH_TASKS = 50_000      # the sketch of frequent keys grows with the shuffle partitions up to here


def _tasks(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), SKETCH_TASKS)


def hot_keys(rows: DataFrame, key: str = "CustomerID", pieces: int = PIECES) -> dict[str, int]:
    """Keys that hold more than ``1 / pieces`` of a task's fair share of ``rows``, and into how many
    pieces of that size each is to be cut.

    One pass over the key column with Spark's mergeable frequent-items sketch.  The sketch tracks
    16 items per possible hot key, so its error lies below the share that makes a key hot and
    none is missed; it names at most ``pieces`` keys per shuffle partition.
    """
    most = pieces * _tasks(rows)
    found = rows.agg(F.expr(f"approx_top_k(`{key}`, {most}, {4 * most})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return _pieces({r["item"]: r["count"] for r in found["top"]}, found["n"], most)


def hot_keys_of_counts(counts: DataFrame, key: str = "CustomerID", n: str = "n", pieces: int = PIECES) -> dict[str, int]:
    """``hot_keys`` from a table that has the exact number of rows ``n`` of every key."""
    most = pieces * _tasks(counts)
    total = counts.agg(F.sum(n)).first()[0] or 0
    top = counts.where(F.col(n) * most > total).select(key, n).collect()          # fewer than ``most`` can hold so much
    return _pieces({r[key]: r[n] for r in top}, total, most)


def _pieces(counts: dict, total: int, most: int) -> dict[str, int]:
    return {k: -(-n * most // total) for k, n in counts.items() if k is not None and n * most > total}


def salted_left_join(big: DataFrame, small: DataFrame, key: str, hot: dict[str, int], pieces: int = PIECES) -> DataFrame:
    """Left join ``big`` to ``small`` (unique on ``key``) with only the ``hot`` keys salted.

    A row of a hot key, or of none (null), gets a salt from a hash of its own columns, the same on
    every retry; all other rows have salt 0.  ``small`` repeats just its hot rows, once per
    salt: at most ``pieces`` rows per shuffle partition more.
    """
    spark = big.sparkSession
    rest = [c for c in big.columns if c != key]
    table = spark.createDataFrame(sorted(hot.items()), f"`{key}` string, _n int")
    table = F.broadcast(table.select(F.col(key).cast(big.schema[key].dataType), "_n"))       # a row per hot key
    n = F.when(F.col(key).isNull(), F.lit(pieces * _tasks(big))).otherwise(F.coalesce("_n", F.lit(1)))
    b = big.join(table, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*rest), n).cast("int")).drop("_n")
    s = (small.join(table, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_n"))
    return b.join(s, [key, "_salt"], "left").drop("_salt")


def scored_lines(lines: DataFrame, scores: DataFrame, key: str = "CustomerID",
                 score_col: str = "CLV_Prediction", salts: int = PIECES, hot: dict[str, int] | None = None) -> DataFrame:
    """Attach each customer's own score to its lines (left join).

    Customers with so many lines that their task would stand out (``hot_keys``, or ``hot`` from
    who knows their counts) are spread over several tasks, and so are lines without a customer;
    everyone else is joined as is.  ``salts=1`` gives the plain join.
    """
    small = scores.select(key, score_col)
    if salts <= 1:
        return lines.join(small, key, "left")
    return salted_left_join(lines, small, key, hot_keys(lines, key, salts) if hot is None else hot, salts)


def scored_projection(scored: DataFrame) -> DataFrame:
    """C15 + C13: the relational sink row -- helper columns dropped, the
    invoice time restored from epoch seconds."""
    return scored.select(
        "Country", "CustomerID", "Description",
        from_epoch_seconds("invoice_epoch").alias("InvoiceDate"),
        "InvoiceNo", "Quantity", "StockCode", "UnitPrice", "Revenue", "CLV_Prediction")


def cents(c: str | Column) -> Column:
    """A double rounded to whole cents as bigint: ``round(x * 100)``.

    Rounding to an integer is exact on the double's value in every engine,
    unlike rounding to decimal places (which some engines do on the printed
    form); the text is then made from the exact cents.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(100.0)).cast("bigint")


def money_text(c: str | Column) -> Column:
    """Money as fixed two-decimal text, e.g. ``-1234.50``."""
    return (cents(c).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("string")


def money_value(c: str | Column) -> Column:
    """Money rounded to cents, as double."""
    return cents(c).cast("double") / F.lit(100.0)


def _text(c: str) -> Column:
    col = F.col(c)
    if c == "InvoiceDate":
        return datetime_text(from_epoch_seconds("invoice_epoch"), "T")
    return col.cast("string")


def row_key() -> Column:
    """``{InvoiceNo}-{CustomerID}``, the fixed key format; a missing part is empty text.
    Parts that spell the same key (null and empty, or a hyphen inside) are one row."""
    return F.concat(F.coalesce("InvoiceNo", F.lit("")), F.lit("-"), F.coalesce("CustomerID", F.lit("")))


def kv_rows(scored: DataFrame, cells=KV_CELLS) -> DataFrame:
    """K4: row key ``{InvoiceNo}-{CustomerID}`` plus every cell as text.

    Numbers are written in full, not rounded.  The key stays a string (no int()
    normalisation, so non-numeric invoice numbers are kept)."""
    return scored.select(row_key().alias("rowkey"), *[_text(c).alias(f"cf_{c}") for c in cells])


def kv_upsert_latest(scored: DataFrame, cells=KV_CELLS, position: str = "item_pos") -> DataFrame:
    """K3: one wide-column row per key, the last put winning.

    Puts arrive in the order of the invoices' time and, within an invoice, of
    its items (``position``, from ``explode_items``).  The order is one bigint and
    the cells are still numbers here, so ``max_by`` runs as a hash aggregation
    with map-side combine; only the surviving rows are formatted as text.
    """
    order = F.col("invoice_epoch").cast("bigint") * F.lit(1 << 31) + F.col(position).cast("bigint")
    cols = list(dict.fromkeys([c for c in cells if c != "InvoiceDate"] + ["invoice_epoch"]))
    # by the key that is stored: two pairs that spell one key are one row, of the last put
    last = (scored.withColumn("_o", order).groupBy(row_key().alias("rowkey"))
                  .agg(*[F.max_by(c, "_o").alias(c) for c in cols]))
    return last.select("rowkey", *[_text(c).alias(f"cf_{c}") for c in cells])
