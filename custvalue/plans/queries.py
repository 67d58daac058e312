"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query composes the library's operators over the fixture views; the SQL
twin of each (where SQL can express it) lives in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from ..operators import nested as N
from ..operators import ranking as R
from ..operators import scoring as S
from ..operators import series as SE
from ..schemas import LINE_COLUMNS
from ..session import cut_lineage
from ..sources import fixtures as FX
from .oracle import REF_DATE, SNAPSHOT_CUTOFF, SPLIT_DATE

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

SAMPLE_SIZE = 10_000      # fixed sample size of the series model
TRAIN_PCT = 80            # train share of the customer split


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def lines(spark, sf, keep_keys=False) -> DataFrame:
    """Cleaned invoice lines (the common input of the feature queries)."""
    return C.clean_lines(FX.invoice_lines(spark, sf, keep_keys=keep_keys))


def dirty_clean(spark, sf, keep_keys=False) -> DataFrame:
    return C.clean_lines(FX.dirty_lines(spark, sf, keep_keys=keep_keys))


def scores(spark, sf) -> DataFrame:
    return S.score_features(FE.customer_features(lines(spark, sf), REF_DATE))


def scored(spark, sf) -> DataFrame:
    return S.scored_lines(lines(spark, sf), scores(spark, sf))


def feed_snapshots(spark, sf):
    feed = FX.score_events(spark, sf)
    prev = R.latest_per_key(feed.filter(F.col("ts") < F.lit(SNAPSHOT_CUTOFF)
                                        .cast("timestamp_ntz")))
    cur = R.latest_per_key(feed)
    return prev, cur


def invoice_series(spark, sf) -> DataFrame:
    """Per-invoice totals of notebook-clean lines, in invoice order."""
    return FE.invoice_totals(C.notebook_clean(lines(spark, sf)))


# ---- 2.4 cleaning ---------------------------------------------------------

@query("clean_lines")
def q_clean_lines(spark, sf):
    return dirty_clean(spark, sf).select(*C.CLEAN_COLUMNS)


@query("time_parts")
def q_time_parts(spark, sf):
    from ..functions.columns import parse_invoice_ts
    df = FX.invoice_lines(spark, sf).withColumn("invoice_ts", parse_invoice_ts("InvoiceDate"))
    return C.time_parts(df).select("InvoiceNo", "StockCode", "InvoiceDate",
                                   "hour", "dayofweek", "weekend")


@query("required_rows")
def q_required_rows(spark, sf):
    return C.required_rows(FX.dirty_lines(spark, sf)).select(*LINE_COLUMNS)


@query("fill_defaults")
def q_fill_defaults(spark, sf):
    return C.fill_defaults(FX.dirty_lines(spark, sf)).select(*LINE_COLUMNS)


@query("epoch_roundtrip")
def q_epoch_roundtrip(spark, sf):
    return C.epoch_roundtrip(dirty_clean(spark, sf))


@query("dedup_customer")
def q_dedup_customer(spark, sf):
    return C.dedup_customer(lines(spark, sf).select(*C.CLEAN_COLUMNS))


@query("notebook_clean")
def q_notebook_clean(spark, sf):
    return C.notebook_clean(FX.dirty_lines(spark, sf)).select(*LINE_COLUMNS)


@query("normalise_lines")
def q_normalise_lines(spark, sf):
    return C.normalise_lines(FX.dirty_lines(spark, sf))


# ---- 2.3 nested / JSON ----------------------------------------------------

@query("explode_items")
def q_explode_items(spark, sf):
    return N.explode_items(FX.invoices(spark, sf))


@query("json_parse")
def q_json_parse(spark, sf):
    ev = FX.table(spark, sf, "events")
    return N.parse_json(ev, "k int", "props", keep=("event_id",))


@query("nest_invoices")
def q_nest_invoices(spark, sf):
    inv = FX.invoices(spark, sf)
    return inv.select(
        *N.INVOICE_KEYS, F.size("Items").alias("n_items"),
        F.aggregate("Items", F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x["Quantity"]).alias("total_qty"),
        F.array_join(F.transform("Items", lambda x: x["StockCode"]), ",").alias("stock_codes"))


@query("to_json_events")
def q_to_json_events(spark, sf):
    return N.to_json_value(FX.invoices(spark, sf), key_col="InvoiceNo")


def _dirty_ingest(spark, sf):
    raw = N.to_json_value(FX.invoices(spark, sf, dirty=True))
    return N.split_ingest(raw)


@query("ingest_valid")
def q_ingest_valid(spark, sf):
    valid, _ = _dirty_ingest(spark, sf)
    return valid.select(*N.INVOICE_KEYS, F.size("Items").alias("n_items"))


@query("ingest_quarantine")
def q_ingest_quarantine(spark, sf):
    _, bad = _dirty_ingest(spark, sf)
    return bad.select("InvoiceNo", "reason")


# ---- 2.5 / 2.6 aggregation and joins --------------------------------------

@query("cust_features")
def q_cust_features(spark, sf):
    return FE.customer_features(lines(spark, sf), REF_DATE)


@query("cust_medians")
def q_cust_medians(spark, sf):
    return FE.customer_medians(lines(spark, sf))


@query("cust_invoice_frequency")
def q_cust_invoice_frequency(spark, sf):
    return FE.invoice_frequency(lines(spark, sf))


@query("returns")
def q_returns(spark, sf):
    return FE.customer_returns(lines(spark, sf))


@query("features_by_joins")
def q_features_by_joins(spark, sf):
    return FE.features_by_joins(lines(spark, sf), REF_DATE)


@query("target_rev")
def q_target_rev(spark, sf):
    return FE.features_with_target(lines(spark, sf), REF_DATE)


@query("features_target_split")
def q_features_target_split(spark, sf):
    return FE.features_with_target(lines(spark, sf), REF_DATE, split_date=SPLIT_DATE)


@query("invoice_totals")
def q_invoice_totals(spark, sf):
    return FE.invoice_totals(lines(spark, sf))


@query("null_profile")
def q_null_profile(spark, sf):
    return FE.null_profile(FX.dirty_lines(spark, sf))


@query("describe_lines")
def q_describe_lines(spark, sf):
    d = FE.describe_numeric(lines(spark, sf), ["Quantity", "UnitPrice", "Revenue"])
    # the order of a sum of doubles shows in the last digits only
    return d.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "stddev", "q25", "q50", "q75")], "min", "max")


@query("score_foreign")
def q_score_foreign(spark, sf):
    """The value formula as a coefficient file, scored through the foreign-model route."""
    import json
    from ..session import scratch_path
    path = scratch_path(spark, "foreign-model") + "/model"
    spec = json.dumps({"intercept": 0.0, "coefficients": [w for _, w in S.SCORE_WEIGHTS]})
    spark.createDataFrame([(spec,)], "value string").coalesce(1).write.text(path)
    return S.score_with_file(FE.customer_features(lines(spark, sf), REF_DATE), path, [c for c, _ in S.SCORE_WEIGHTS])


@query("clean_counts")
def q_clean_counts(spark, sf):
    return FE.clean_counts(FX.dirty_lines(spark, sf))


# ---- 2.7 splits, samples, series ------------------------------------------

@query("train_test_split")
def q_train_test_split(spark, sf):
    feats = FE.customer_features(lines(spark, sf), REF_DATE)
    return SE.hash_split(feats, "CustomerID", TRAIN_PCT).select("CustomerID", "bucket", "split")


@query("hash_sample")
def q_hash_sample(spark, sf):
    return SE.hash_sample(invoice_series(spark, sf), "InvoiceNo", SAMPLE_SIZE)


def _series_split(spark, sf):
    return SE.sequential_split(invoice_series(spark, sf), [F.col("InvoiceNo")])


@query("series_split")
def q_series_split(spark, sf):
    return _series_split(spark, sf).select("InvoiceNo", "TotalValue", "pos", "split", "split_pos")


@query("series_windows")
def q_series_windows(spark, sf):
    return SE.supervised_windows(_series_split(spark, sf), "TotalValue", time_step=2)


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    s = _series_split(spark, sf)
    lo, hi = SE.minmax_params(s.filter(F.col("split") == "train"), "TotalValue")
    return SE.minmax_scale(s, "TotalValue", lo, hi).select("InvoiceNo", "split", "scaled")


@query("regression_metrics")
def q_regression_metrics(spark, sf):
    ft = FE.features_with_target(lines(spark, sf), REF_DATE, split_date=SPLIT_DATE)
    pred = ft.select("target_rev", S.linear_score().alias("pred"))
    return SE.regression_metrics(pred, "pred", "target_rev").drop("n_unknown")


# ---- 2.10 scoring and sinks -----------------------------------------------

@query("score_features")
def q_score_features(spark, sf):
    return scores(spark, sf)


@query("scored_lines")
def q_scored_lines(spark, sf):
    return scored(spark, sf).select(*C.CLEAN_COLUMNS, "CLV_Prediction")


@query("scored_projection")
def q_scored_projection(spark, sf):
    return S.scored_projection(scored(spark, sf))


@query("kv_rowkey")
def q_kv_rowkey(spark, sf):
    return S.kv_rows(scored(spark, sf))


@query("kv_upsert_latest")
def q_kv_upsert_latest(spark, sf):
    placed = C.clean_lines(N.explode_items(FX.invoices(spark, sf), "item_pos"))
    # the line counts among the features name the hot customers; both come from one aggregation
    feats = cut_lineage(FE.customer_features(lines(spark, sf), REF_DATE))
    hot = S.hot_keys_of_counts(feats, n="frequency")
    return S.kv_upsert_latest(S.scored_lines(placed, S.score_features(feats), hot=hot))


@query("prediction_feed")
def q_prediction_feed(spark, sf):
    return R.prediction_feed(scores(spark, sf))


# ---- 2.7 rankings and views -----------------------------------------------

@query("top10_clv")
def q_top10_clv(spark, sf):
    _, cur = feed_snapshots(spark, sf)
    return R.top_k(cur.select("key", "clv"), 10)


@query("rank_change")
def q_rank_change(spark, sf):
    prev, cur = feed_snapshots(spark, sf)
    return R.rank_change(prev.select("key", "clv"), cur.select("key", "clv"))


@query("clv_by_day")
def q_clv_by_day(spark, sf):
    return R.clv_by_day(FX.score_events(spark, sf))


@query("serving_view")
def q_serving_view(spark, sf):
    cust = FX.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"))
    _, cur = feed_snapshots(spark, sf)
    return R.serving_view(cust, cur)


@query("raw_union")
def q_raw_union(spark, sf):
    il = FX.invoice_lines(spark, sf)
    cut = F.col("InvoiceDate") < F.lit("1998-01-01")
    first = il.filter(cut).select(*LINE_COLUMNS)
    later = il.filter(~cut).select(*LINE_COLUMNS).withColumn("batch", F.lit(2))
    return first.unionByName(later, allowMissingColumns=True)


@query("window_features")
def q_window_features(spark, sf):
    return FE.window_features(lines(spark, sf))
