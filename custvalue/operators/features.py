"""Per-customer features (A1-A17) and the joins around them.

The whole feature vector is ONE ``groupBy(CustomerID).agg(...)``: a single
shuffle with map-side partial aggregation, instead of ten aggregations and a
chain of joins.  Every aggregate is mergeable (sums, counts, min, max; the
medians come from per-value counts), so a customer holding a third of all
lines is pre-combined in every map task and never lands whole in one task.
"""

from __future__ import annotations

import datetime as _dt
import math

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (HOURS, WEEKDAYS, count_parts, median_from_counts, median_sql, money_of,
                                 revenue_parts, revenue_sum)

# Aggregate-buffer columns of the two exact medians.
_MEDIAN_PARTS = [c for c in ([f"_h{v}" for v in HOURS] + [f"_d{v}" for v in WEEKDAYS])]
from ..schemas import FEATURE_COLUMNS


def _date(d) -> Column:
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(d).cast("date")


def _date_sql(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return f"DATE'{d}'"


def _feature_parts(ref_date=None, when: str | None = None) -> list[Column]:
    """Mergeable aggregate parts of the feature vector.

    Written as SQL text: each part is one expression for the client to send
    (the 31 histogram counters would otherwise cost hundreds of round trips
    per query).  Revenue is summed exactly in integer units of 1/10000.
    With ``when`` (a SQL condition) only rows satisfying it contribute, so
    several periods can be aggregated in the same pass.
    """
    def on(x: str) -> str:
        return x if when is None else f"CASE WHEN {when} THEN {x} END"

    def flag(x: str) -> str:
        return x if when is None else f"({when}) AND ({x})"

    parts = [
        f"min({on('to_date(invoice_ts)')}) AS _first",
        f"max({on('to_date(invoice_ts)')}) AS _last",
        f"count({on('InvoiceNo')}) AS frequency",
        f"sum({on('Quantity')}) AS _qty",
        f"count(CASE WHEN {flag('Revenue < 0')} THEN InvoiceNo END) AS num_returns",
        *[f"sum(CASE WHEN {flag(f'hour = {v}')} THEN 1 ELSE 0 END) AS _h{v}" for v in HOURS],
        *[f"sum(CASE WHEN {flag(f'dayofweek = {v}')} THEN 1 ELSE 0 END) AS _d{v}"
          for v in WEEKDAYS],
        f"sum({on('weekend')}) AS _wkd",
        f"count({on('1')}) AS _n",
    ]
    return [*revenue_parts("_rev", when), *[F.expr(p) for p in parts]]


def median_columns() -> list[Column]:
    """Exact medians of hour and weekday from the histogram parts."""
    return [median_from_counts("_h", HOURS).alias("purchase_hour_med"),
            median_from_counts("_d", WEEKDAYS).alias("purchase_dow_med")]


def _finish(parts: DataFrame, ref_date, key: str, extra: list[str] = ()) -> DataFrame:
    """Turn the aggregate parts into the eleven features (null -> 0), in one
    projection."""
    d = _date_sql(ref_date)
    rev = money_of("_rev")
    freq = "CAST(frequency AS DOUBLE)"
    t = f"datediff({d}, _first)"
    exprs = [
        f"`{key}`",
        f"coalesce({rev}, 0.0) AS total_revenue",
        "coalesce(datediff(_last, _first), 0) AS recency",
        "frequency",
        f"coalesce({t}, 0) AS t",
        f"coalesce(try_divide(CAST({t} AS DOUBLE), {freq}), 0.0) AS time_between",
        f"coalesce(try_divide({rev}, {freq}), 0.0) AS avg_basket_value",
        f"coalesce(try_divide(CAST(_qty AS DOUBLE), {freq}), 0.0) AS avg_basket_size",
        "num_returns",
        f"coalesce({median_sql('_h', HOURS)}, 0) AS purchase_hour_med",
        f"coalesce({median_sql('_d', WEEKDAYS)}, 0) AS purchase_dow_med",
        "coalesce(try_divide(CAST(_wkd AS DOUBLE), CAST(_n AS DOUBLE)), 0.0) "
        "AS purchase_weekend_prop",
        *extra,
    ]
    return parts.selectExpr(*exprs)


def customer_features(lines: DataFrame, ref_date="2011-06-11",
                      key: str = "CustomerID", keep_null_key: bool = False) -> DataFrame:
    """A1-A11 + A13: the feature vector of every customer, one aggregation.

    ``lines`` are cleaned lines (``clean_lines``).  ``recency`` is the span
    between first and last purchase day; ``t`` the days from the first
    purchase to ``ref_date``; ``frequency`` counts lines.
    """
    src = lines if keep_null_key else lines.filter(F.col(key).isNotNull())
    parts = src.groupBy(key).agg(*_feature_parts(ref_date))
    return _finish(parts, ref_date, key)


def merge_feature_parts(parts: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Combine partial rows of ``_feature_parts`` (several per customer) into one
    each: counts and sums add up, first and last days are the extremes."""
    best = {"_first": F.min, "_last": F.max}
    return parts.groupBy(key).agg(*[best.get(c, F.sum)(c).alias(c) for c in parts.columns if c != key])


def customer_medians(lines: DataFrame, key: str = "CustomerID") -> DataFrame:
    """A9/A10 on their own: median hour and weekday per customer.

    Exact at any group size: hour and weekday have 24 and 7 values, so the
    median comes from per-value counts (plain sums, combined map-side) rather
    than from an approximate quantile sketch.
    """
    parts = (lines.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(*count_parts("hour", HOURS, "_h"), *count_parts("dayofweek", WEEKDAYS, "_d")))
    return parts.select(key, *median_columns())


def customer_returns(lines: DataFrame, key: str = "CustomerID") -> DataFrame:
    """A8 alone: customers with at least one negative-revenue line."""
    return (lines.filter((F.col("Revenue") < 0) & F.col(key).isNotNull())
                 .groupBy(key).agg(F.count("InvoiceNo").alias("num_returns")))


def invoice_frequency(lines: DataFrame, key: str = "CustomerID") -> DataFrame:
    """A3 extra: distinct invoices per customer (``frequency`` counts lines).

    Two-level aggregation instead of ``count(DISTINCT ...)`` inside the
    feature aggregate (which would expand every row): (customer, invoice)
    pairs are combined map-side, then counted per customer.  Lines and
    invoices are reported together so both notions of frequency are at hand.
    """
    pairs = (lines.filter(F.col(key).isNotNull() & F.col("InvoiceNo").isNotNull())
                  .groupBy(key, "InvoiceNo").agg(F.count(F.lit(1)).alias("_lines")))
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("frequency_invoices"),
                                  F.sum("_lines").alias("frequency_lines"))


def features_by_joins(lines: DataFrame, ref_date="2011-06-11",
                      key: str = "CustomerID") -> DataFrame:
    """The source system's shape -- one aggregate per feature, then
    left joins on the key.  Kept for parity checks and the benchmark; the
    result equals ``customer_features``."""
    src = lines.filter(F.col(key).isNotNull())
    day = F.to_date("invoice_ts")
    g = src.groupBy(key)
    total = g.agg(revenue_sum().alias("total_revenue"))
    recency = g.agg(F.datediff(F.max(day), F.min(day)).alias("recency"))
    freq = g.agg(F.count("InvoiceNo").alias("frequency"))
    t = g.agg(F.datediff(_date(ref_date), F.min(day)).alias("t"))
    tb = t.join(freq, key).select(
        key, F.try_divide(F.col("t").cast("double"), F.col("frequency").cast("double"))
        .alias("time_between"))
    abv = total.join(freq, key).select(
        key, F.try_divide("total_revenue", F.col("frequency").cast("double"))
        .alias("avg_basket_value"))
    abs_ = g.agg(F.try_divide(F.sum("Quantity").cast("double"),
                              F.count("InvoiceNo").cast("double")).alias("avg_basket_size"))
    ret = customer_returns(src, key)
    med = customer_medians(src, key)
    wk = g.agg(F.try_divide(F.sum("weekend").cast("double"), F.count(F.lit(1)).cast("double"))
               .alias("purchase_weekend_prop"))
    out = total
    for part in (recency, freq, t, tb, abv, abs_, ret, med, wk):
        out = out.join(part, key, "left")
    return out.select(key, *FEATURE_COLUMNS).na.fill(0, subset=FEATURE_COLUMNS)


def target_revenue(lines: DataFrame, key: str = "CustomerID") -> DataFrame:
    """target_rev = sum(Revenue) per customer."""
    return (lines.filter(F.col(key).isNotNull()).groupBy(key)
                 .agg(revenue_sum().alias("target_rev")))


def features_with_target(lines: DataFrame, ref_date="2011-06-11",
                         split_date: str | None = None,
                         key: str = "CustomerID") -> DataFrame:
    """A12 + J3: features with the training label.

    Without ``split_date`` the label is the revenue of the same period (the
    source system's behaviour: it equals ``total_revenue``).  With it,
    features come from lines before ``split_date`` and the label is the
    revenue from ``split_date`` on (0 when there is none); customers need at
    least one line before the split.  Both periods are aggregated in the same
    pass with conditional aggregates: one scan, one shuffle, no join.
    """
    if split_date is None:
        feats = customer_features(lines, ref_date, key)
        return feats.withColumn("target_rev", F.col("total_revenue"))
    cut = f"TIMESTAMP_NTZ'{split_date} 00:00:00'" if len(split_date) == 10 \
        else f"TIMESTAMP_NTZ'{split_date}'"
    parts = (lines.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(*_feature_parts(ref_date, when=f"invoice_ts < {cut}"),
                       *revenue_parts("_target", f"invoice_ts >= {cut}"))
                  .filter(F.col("_n") > 0))
    feats = _finish(parts, ref_date, key, extra=[
        f"coalesce({money_of('_target')}, 0.0) AS target_rev"])
    return feats


def invoice_totals(lines: DataFrame) -> DataFrame:
    """Total value per invoice."""
    return (lines.groupBy("InvoiceNo")
                 .agg(revenue_sum().alias("TotalValue")))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one pass, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, stddev, min, quartiles and max per numeric column (long format).

    Plain double values of any size: mean and variance merge pairwise by their
    deviations (no large squares are subtracted).  Null and NaN do not count.

    The quartiles are exact (linear between neighbours): see ``exact_quantiles``.
    """
    spark = df.sparkSession
    df = df.select(*cols).persist()                        # every round of the quantiles reads it again
    try:
        found = _cells(df, cols).groupBy("column").agg(
            F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev("v").alias("stddev"),
            F.min("v").alias("min"), F.max("v").alias("max"))
        stats = spark.createDataFrame(found.collect(), found.schema)             # one row per column
        quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    finally:
        df.unpersist()
    q = quartiles.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    q = q.select("column", F.col("`0.25`").alias("q25"), F.col("`0.5`").alias("q50"), F.col("`0.75`").alias("q75"))
    names = spark.createDataFrame([(c,) for c in cols], "column string")
    return (names.join(F.broadcast(stats), "column", "left").join(F.broadcast(q), "column", "left")   # one row per column
            .select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "stddev", "min", "q25", "q50", "q75", "max"))


def _cells(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, v) of every number in ``cols``."""
    cell = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]
    return df.select(F.inline(F.array(*cell))).where("v is not null and not isnan(v)")


QUANTILE_CELLS = 4096      # cells of an interval in one round


def exact_quantiles(df: DataFrame, cols: list[str], probabilities: list[float]) -> DataFrame:
    """``column, p, value``: exact quantiles, linear between the two neighbouring values.

    Histogram refinement: a round counts the values in the cells of every interval that
    holds a wanted rank, with the smallest and largest value of each cell; the cell with
    the rank is the next interval, until it is one value.  The counts are a mergeable
    aggregation; at most ``QUANTILE_CELLS`` rows per wanted rank reach the driver, and
    no value list does.  Infinite values count as the largest finite ones.
    """
    spark = df.sparkSession
    top = float(np.finfo(np.float64).max)
    cells = _cells(df, cols).select("column", F.greatest(F.lit(-top), F.least(F.lit(top), F.col("v"))).alias("v"))
    sizes = {r["column"]: r for r in cells.groupBy("column").agg(
        F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    ranks = {(c, k) for c, r in sizes.items() for p in probabilities
             for k in (math.floor(p * (r["n"] - 1)), math.ceil(p * (r["n"] - 1)))}
    left = {(c, k): (sizes[c]["lo"], sizes[c]["hi"], k) for c, k in ranks}
    value: dict = {}
    while True:
        value.update({w: lo for w, (lo, hi, _) in left.items() if lo == hi})
        left = {w: x for w, x in left.items() if w not in value}
        if not left:
            break
        held = spark.createDataFrame(sorted({(c, lo, hi) for (c, _), (lo, hi, _) in left.items()}),
                                     "column string, lo double, hi double")
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        cell = F.least(F.floor(share * QUANTILE_CELLS), F.lit(QUANTILE_CELLS - 1))
        counts: dict = {}
        for r in (cells.join(F.broadcast(held), "column").where("v between lo and hi")      # a row per wanted rank
                  .groupBy("column", "lo", "hi", cell.alias("cell"))
                  .agg(F.count("v").alias("n"), F.min("v").alias("first"), F.max("v").alias("last")).collect()):
            counts.setdefault((r["column"], r["lo"], r["hi"]), []).append((r["cell"], r["n"], r["first"], r["last"]))
        for w, (lo, hi, rank) in left.items():
            for _, n, first, last in sorted(counts[(w[0], lo, hi)]):
                if rank < n:
                    left[w] = (first, last, rank)
                    break
                rank -= n
    out = []
    for c, r in sizes.items():
        for p in probabilities:
            at = p * (r["n"] - 1)
            lo, hi = value[(c, math.floor(at))], value[(c, math.ceil(at))]
            out.append((c, float(p), lo + (hi - lo) * (at - math.floor(at))))
    return spark.createDataFrame(out, "column string, p double, value double")


def clean_counts(raw: DataFrame) -> DataFrame:
    """Row counts through the cleaning steps, one pass.

    rows_in; after dropping incomplete rows; with an unparseable date; with a
    price out of range (both quarantined); kept by ``clean_lines``; kept by the
    notebook filter.
    """
    from ..functions.columns import money_ok, parse_invoice_ts, to_int_truncating
    complete = (F.col("InvoiceDate").isNotNull() & F.col("Quantity").isNotNull()
                & F.col("UnitPrice").isNotNull())
    parsed = parse_invoice_ts("InvoiceDate").isNotNull()
    qty = to_int_truncating("Quantity")
    priced = money_ok(qty, F.col("UnitPrice").try_cast("double"))
    kept = complete & parsed & qty.isNotNull() & priced
    nb = (F.col("CustomerID").isNotNull() & (F.col("UnitPrice") > 0) & (F.col("Quantity") > 0))
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(complete).alias("rows_complete"),
        F.count_if(complete & ~parsed).alias("rows_bad_date"),
        F.count_if(complete & parsed & qty.isNotNull() & ~priced).alias("rows_bad_price"),
        F.count_if(kept).alias("rows_clean"),
        F.count_if(F.coalesce(nb, F.lit(False))).alias("rows_notebook"))


def window_features(lines: DataFrame, window: str = "30 days",
                    key: str = "CustomerID", ts: str = "invoice_ts") -> DataFrame:
    """T4 (batch form): features per customer and tumbling time window.

    ``recency`` is the days from the last purchase day to the window end (a
    deterministic stand-in for "days until today").  The return flag is
    Revenue < 0; medians come from per-value counts
    instead of collected per-window lists, so the same aggregate runs in a
    stream.
    """
    w = F.window(F.col(ts), window)
    g = (lines.filter(F.col(key).isNotNull()).groupBy(w.alias("w"), key)
              .agg(revenue_sum().alias("total_revenue"),
                   F.count("InvoiceNo").alias("frequency"),
                   F.count(F.when(F.col("Revenue") < 0, 1)).alias("num_returns"),
                   *count_parts("hour", HOURS, "_h"), *count_parts("dayofweek", WEEKDAYS, "_d"),
                   F.max(ts).alias("last_ts")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key, "total_revenue", "frequency",
                    "num_returns", *median_columns(), "last_ts",
                    F.datediff(F.to_date("w.end"), F.to_date("last_ts")).alias("recency"))


def window_parts(lines: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Mergeable parts of the window features of lines that carry ``window_start`` and ``window_end``."""
    return (lines.groupBy("window_start", "window_end", key)
                 .agg(*revenue_parts("_rev"), F.count("InvoiceNo").alias("frequency"),
                      F.count(F.when(F.col("Revenue") < 0, 1)).alias("num_returns"),
                      *count_parts("hour", HOURS, "_h"), *count_parts("dayofweek", WEEKDAYS, "_d"),
                      F.max("invoice_ts").alias("last_ts")))


def finish_window_parts(parts: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Window features from any number of ``window_parts`` rows per customer and window."""
    by = ["window_start", "window_end", key]
    merged = parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in (*by, "last_ts")],
                                    F.max("last_ts").alias("last_ts"))
    return merged.select(*by, F.expr(money_of("_rev")).alias("total_revenue"), "frequency", "num_returns",
                         *median_columns(), "last_ts",
                         F.datediff(F.to_date("window_end"), F.to_date("last_ts")).alias("recency"))
