"""Sampling, splits, the invoice-value series and model metrics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket, md5_rank_key
from .order import global_positions


def hash_split(df: DataFrame, key: str, train_pct: int = 80,
               label_col: str = "split") -> DataFrame:
    """train/test by a stable hash bucket of the key.

    Unlike ``randomSplit`` the assignment depends only on the key: it is the
    same after a repartition, a retry or an executor loss.
    """
    b = hash_bucket(key, 100)
    return df.withColumn("bucket", b).withColumn(
        label_col, F.when(F.col("bucket") < train_pct, "train").otherwise("test"))


def hash_sample(df: DataFrame, key: str, n: int = 10_000) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, repeatable: smallest md5(key).

    Counts per md5 prefix (at most 65,536 groups, combined map-side) give the
    cut-off first; only rows up to it -- about n in all, wherever they lie --
    are ordered.  Without it every task would send its own n best rows.
    """
    prefix = F.conv(F.substring(md5_rank_key(key), 1, 4), 16, 10).cast("int")
    counts = df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("c")).orderBy("p").collect()
    seen, last = 0, 1 << 16
    for r in counts:
        seen, last = seen + r["c"], r["p"]
        if seen >= n:
            break
    return df.filter(prefix <= last).orderBy(md5_rank_key(key), F.col(key)).limit(n)


def sequential_split(series: DataFrame, order: list, train: float = 0.6,
                     val: float = 0.2, pos_col: str = "pos") -> DataFrame:
    """Positions in ``order``; first floor(n*train) rows train, next
    floor(n*val) validation, rest test.  Adds ``pos``, ``split``, ``split_pos``."""
    ranked = global_positions(series, order, pos_col)
    n = ranked.count()
    n_train = int(n * train)
    n_val = int(n * val)
    pos = F.col(pos_col)
    split = (F.when(pos < n_train, "train")
              .when(pos < n_train + n_val, "val").otherwise("test"))
    start = (F.when(pos < n_train, F.lit(0))
              .when(pos < n_train + n_val, F.lit(n_train)).otherwise(F.lit(n_train + n_val)))
    return ranked.withColumn("split", split).withColumn("split_pos", pos - start)


def supervised_windows(split_series: DataFrame, value_col: str,
                       time_step: int = 2) -> DataFrame:
    """X = values at t .. t+time_step-1, y = value at t+time_step, built
    inside each split only.  Written as equi-joins on (split, position + k):
    shuffle joins on a unique key, no single-partition window."""
    base = split_series.select("split", "split_pos", F.col(value_col).alias("x0"))
    out = base.withColumnRenamed("split_pos", "t")
    for k in range(1, time_step + 1):
        name = f"x{k}" if k < time_step else "y"
        nxt = base.select("split", (F.col("split_pos") - k).alias("t"), F.col("x0").alias(name))
        out = out.join(nxt, ["split", "t"])
    return out


def minmax_params(df: DataFrame, value_col: str) -> tuple[float | None, float | None]:
    """Min and max of one column (a one-row aggregate)."""
    r = df.agg(F.min(value_col).alias("lo"), F.max(value_col).alias("hi")).first()
    return r["lo"], r["hi"]


def minmax_scale(df: DataFrame, value_col: str, lo: float, hi: float,
                 out_col: str = "scaled") -> DataFrame:
    """(v - lo) / (hi - lo) in [0, 1]; a constant column scales to 0."""
    span = (hi - lo) if hi is not None and lo is not None else None
    if not span:
        return df.withColumn(out_col, F.lit(0.0))
    return df.withColumn(out_col, (F.col(value_col) - F.lit(float(lo))) / F.lit(float(span)))


def minmax_inverse(df: DataFrame, scaled_col: str, lo: float, hi: float,
                   out_col: str = "value") -> DataFrame:
    """Inverse of ``minmax_scale``."""
    return df.withColumn(out_col, F.col(scaled_col) * F.lit(float(hi - lo)) + F.lit(float(lo)))


ERROR_BITS = 40      # errors are summed exactly in units of 2^-40 of the largest error


def regression_metrics(df: DataFrame, pred_col: str, label_col: str) -> DataFrame:
    """MAE, MSE, RMSE (one row).

    Errors are scaled by the power of two that brings the largest one to about
    2^40 (scaling is exact), rounded to integers and summed as decimals: the
    sums do not depend on row order or partitioning, and keep twelve digits
    below the largest error whatever its size.  Rows whose error is null, NaN or
    infinite are counted as ``n_unknown`` and left out; without any other row the
    metrics are null.
    """
    e = F.abs(F.col(pred_col) - F.col(label_col))
    known = ~F.isnan(e) & (e < F.lit(math.inf))           # null, NaN and infinite errors have no size
    df = df.select(F.when(known, e).alias("_e"))
    e = F.col("_e")
    top = df.agg(F.max(e).alias("top")).first()["top"]
    scale = 2.0 ** (ERROR_BITS - math.ceil(math.log2(top))) if top else 1.0
    em = F.round(e * F.lit(scale)).cast("decimal(19,0)")
    m = df.agg(F.count(e).alias("n"), F.count_if(e.isNull()).alias("n_unknown"), F.sum(em).alias("sae"), F.sum((em * em).cast("decimal(38,0)")).alias("sse"))
    n = F.col("n").cast("double")
    mae = F.try_divide(F.col("sae").cast("double"), n * F.lit(scale))
    mse = F.try_divide(F.col("sse").cast("double"), n * F.lit(scale * scale))
    return m.select("n", "n_unknown", mae.alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"))
