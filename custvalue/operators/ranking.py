"""Rankings and serving views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import global_positions


def latest_per_key(feed: DataFrame, key: str = "key", value: str = "clv",
                   order=("ts", "event_id")) -> DataFrame:
    """Latest value per key by a total event order.

    ``max_by`` is a mergeable aggregate: partial results per map task, so a
    key with a third of all events is combined before the shuffle."""
    ordering = F.struct(*order)
    return (feed.groupBy(key)
                .agg(F.max_by(F.col(value), ordering).alias(value),
                     F.max(ordering).alias("_last"))
                .select(key, value, *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order]))


def top_k(scores: DataFrame, k: int = 10, key: str = "key", value: str = "clv") -> DataFrame:
    """K best by value (ties by key); TakeOrderedAndProject keeps k rows
    per task."""
    return scores.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)


def ranked(scores: DataFrame, key: str = "key", value: str = "clv",
           rank_col: str = "rank") -> DataFrame:
    """Rank 1..n over all keys by value desc, key asc, without a global window."""
    pos = global_positions(scores.select(key, value), [F.col(value).desc(), F.col(key).asc()],
                           "_pos")
    return pos.select(key, value, (F.col("_pos") + 1).alias(rank_col))


STEPS = 64   # score buckets per factor e


def score_bucket(value: str = "clv") -> Column:
    """Bucket of a score, falling ranks in falling buckets: a monotone function of the score alone.

    Buckets are about 1.6 % of a score wide, at most 2 x 710 x ``STEPS`` of them at any number of keys.
    NaN ranks above all numbers and null below, as in a descending sort.
    """
    size = F.floor(F.log1p(F.least(F.abs(value), F.lit(1.7e308))) * STEPS).cast("int")
    return (F.when(F.col(value).isNull(), -1_000_000).when(F.isnan(value), 1_000_000)
             .otherwise(F.when(F.col(value) < 0, -1 - size).otherwise(size)))


def placed_in_buckets(rows: DataFrame, key: str = "key", value: str = "clv") -> DataFrame:
    """``rows`` (with ``bucket``) with ``pos``: the place of each in its bucket from 0, by value desc, key asc.
    One distributed sort, so even a bucket with most of the rows is no single task's."""
    at = global_positions(rows, [F.col("bucket").desc(), F.col(value).desc(), F.col(key).asc()], "_pos")
    first = at.groupBy("bucket").agg(F.min("_pos").alias("_first"))
    return at.join(F.broadcast(first), "bucket").withColumn("pos", F.col("_pos") - F.col("_first")).drop("_pos", "_first")


def ranks_of_buckets(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rank of every row of ``rows(bucket, pos, ...)`` by prefix sums of ``counts(bucket, n)`` (one row per bucket)."""
    above = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_above"))
    return rows.join(F.broadcast(starts), "bucket").withColumn("rank", F.col("_above") + F.col("pos") + 1).drop("_above")


def rank_change(previous: DataFrame, current: DataFrame, key: str = "key",
                value: str = "clv") -> DataFrame:
    """Current ranking with its move against the previous ranking:
    ``new`` (absent before), ``up``, ``down`` or ``none``."""
    return rank_move(ranked(previous, key, value, "prev_rank"), ranked(current, key, value, "rank"), key, value)


def rank_move(previous: DataFrame, current: DataFrame, key: str = "key", value: str = "clv") -> DataFrame:
    """``rank_change`` of two rankings: ``previous(key, prev_rank)``, ``current(key, value, rank)``."""
    j = current.join(previous.select(key, "prev_rank"), key, "left")
    change = (F.when(F.col("prev_rank").isNull(), "new")
               .when(F.col("prev_rank") < F.col("rank"), "down")
               .when(F.col("prev_rank") > F.col("rank"), "up")
               .otherwise("none"))
    return j.select(key, value, "rank", "prev_rank", change.alias("change"))


def clv_by_day(feed: DataFrame, ts: str = "ts", value: str = "clv") -> DataFrame:
    """The prediction line series, one point per day (count, sum, mean, max)."""
    d = F.col(value).cast("decimal(28,10)")
    g = feed.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(value).alias("n_scores"), F.sum(d).alias("_s"), F.max(value).alias("clv_max"))
    return g.select("day", "n_scores", F.col("_s").cast("double").alias("clv_total"),
                    (F.col("_s").cast("double") / F.col("n_scores").cast("double")).alias("clv_avg"),
                    "clv_max")


def serving_view(entities: DataFrame, scores: DataFrame, key: str = "key",
                 value: str = "clv") -> DataFrame:
    """Every entity with its score as text, 'N/A' when it has none."""
    j = entities.join(scores.select(key, value), key, "left")
    from .scoring import money_text
    txt = F.coalesce(money_text(value), F.lit("N/A"))
    return j.select(*entities.columns, txt.alias("clv_text"))


def prediction_feed(scores: DataFrame, key: str = "CustomerID",
                    value: str = "CLV_Prediction") -> DataFrame:
    """The {key, clv} message emitted after each upsert, the score in full."""
    msg = F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("clv"))
    return scores.select(F.col(key).cast("string").alias("key"), F.col(value).alias("clv"),
                         F.to_json(msg).alias("value"))
