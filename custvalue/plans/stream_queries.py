"""Streaming queries, registered like the batch ones.

Each query lays its input down as stream files (derived by Spark from the
driver tables) in a fresh folder under the shared checkpoint root, runs the
stream with ``availableNow`` to completion, and returns the sink read back as
a batch DataFrame -- so it can be compared with the batch SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean as C
from ..operators import nested as N
from ..schemas import LINE_COLUMNS
from ..session import scratch_path, shuffles_dropped
from ..sources import fixtures as FX
from ..streaming import streams as ST
from .oracle import LATE_CUTS, LATE_MODULUS, REF_DATE, SPLIT_DATE
from .queries import query

BATCH_CUTOFF = SPLIT_DATE   # invoices before it arrive in the first micro-batch of a two-batch replay
TEXT = T.StructType([T.StructField("value", T.StringType())])
FEED = T.StructType([T.StructField("value", T.StringType()),
                     T.StructField("ts", T.TimestampNTZType()),
                     T.StructField("event_id", T.LongType())])


def _files(spark) -> int:
    """Replay files: as many as shuffle partitions, which are sized to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _invoice_texts(spark, sf, root, order=None):
    """Nested invoices as JSON text files (one message per line)."""
    inv = FX.invoices(spark, sf, files=_files(spark))
    msgs = inv.select("InvoiceDate", F.to_json(F.struct(*inv.columns)).alias("value"))
    path = f"{root}/in"
    ST.write_replay_files(msgs, path, _files(spark) if order else None, "text", order=order, columns=["value"])
    return path


def _invoice_parts(spark, sf, root, arrives, parts):
    """Nested invoices as JSON text files, each in the folder of the part ``arrives`` says, written in
    one pass.  Gives the path of each part together with all before it: a restarted
    stream that reads it finds the next part's files."""
    inv = FX.invoices(spark, sf, files=_files(spark))
    msgs = inv.select(arrives.cast("int").alias("part"), F.to_json(F.struct(*inv.columns)).alias("value"))
    msgs = msgs.filter(F.col("part").isNotNull())
    ST.write_replay_files(msgs, f"{root}/in", None, "text", columns=["value"], part="part")
    return [f"{root}/in/part=[0-{i}]" for i in range(parts)]


def _invoice_stream(spark, path, per_trigger=None):
    raw = ST.file_source(spark, path, TEXT, "text", per_trigger)
    return ST.invoice_json(raw)


def _two_batches(spark, sf, root, start) -> None:
    """Replay the invoices in two runs of one query (a restart from its
    checkpoint): those before the cut-off, then the rest.  Most customers have
    invoices in both."""
    late = F.col("InvoiceDate") >= F.lit(BATCH_CUTOFF)
    for path in _invoice_parts(spark, sf, root, late, 2):
        ST.finish(start(_invoice_stream(spark, path)))


@query("stream_score")
def q_stream_score(spark, sf):
    """The second batch's scores use the lines of both."""
    root = scratch_path(spark, "stream_score")
    _two_batches(spark, sf, root, lambda inv: ST.start_score_stream(
        inv, f"{root}/out", f"{root}/ckpt", REF_DATE, feed_path=f"{root}/feed"))
    return spark.read.parquet(f"{root}/out").select(*C.CLEAN_COLUMNS, "CLV_Prediction")


@query("stream_prediction_feed")
def q_stream_prediction_feed(spark, sf):
    """The {key, clv} messages the scoring stream emits per batch."""
    root = scratch_path(spark, "stream_prediction_feed")
    _two_batches(spark, sf, root, lambda inv: ST.start_score_stream(
        inv, f"{root}/out", f"{root}/ckpt", REF_DATE, feed_path=f"{root}/feed"))
    return spark.read.parquet(f"{root}/feed").drop("batch_id")


@query("stream_kv_upsert")
def q_stream_kv_upsert(spark, sf):
    """K3 in a stream: scored rows upserted per micro-batch into a table keyed
    by ``{InvoiceNo}-{CustomerID}``."""
    root = scratch_path(spark, "stream_kv_upsert")
    _two_batches(spark, sf, root, lambda inv: ST.start_kv_upsert_stream(inv, f"{root}/table", f"{root}/ckpt", REF_DATE))
    return ST.kv_table(spark, f"{root}/table")


@query("stream_features_batch")
def q_stream_features_batch(spark, sf):
    """Features of each batch on its own."""
    root = scratch_path(spark, "stream_features_batch")
    _two_batches(spark, sf, root, lambda inv: ST.start_batch_features_stream(inv, f"{root}/out", f"{root}/ckpt", REF_DATE))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


@query("stream_features_total")
def q_stream_features_total(spark, sf):
    """The features read from the stream's own state after several batches."""
    root = scratch_path(spark, "stream_features_total")
    src = _invoice_texts(spark, sf, root)
    lines = C.clean_lines(N.explode_items(_invoice_stream(spark, src, max(1, _files(spark) // 4))))
    ST.finish(ST.start_total_features_stream(lines, f"{root}/ckpt", REF_DATE))
    return ST.total_features(spark, f"{root}/ckpt", REF_DATE)


@query("stream_window_features")
def q_stream_window_features(spark, sf):
    root = scratch_path(spark, "stream_window_features")
    src = _invoice_texts(spark, sf, root, order="InvoiceDate")
    lines = C.clean_lines(N.explode_items(_invoice_stream(spark, src)))
    ST.finish(ST.start_window_features_stream(lines, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


@query("stream_invoice_frequency")
def q_stream_invoice_frequency(spark, sf):
    """A3 in a stream: flat lines, the lines of an invoice spread over several batches."""
    root = scratch_path(spark, "stream_invoice_frequency")
    flat = FX.invoice_lines(spark, sf).select(F.to_json(F.struct(*LINE_COLUMNS)).alias("value"))
    ST.write_replay_files(flat, f"{root}/in", _files(spark), "text")
    raw = ST.file_source(spark, f"{root}/in", TEXT, "text", max(1, _files(spark) // 4))
    ST.finish(ST.start_invoice_count_stream(C.clean_lines(ST.flat_json(raw)), f"{root}/ckpt"))
    return ST.invoice_counts(spark, f"{root}/ckpt")


def _windows_with_late_rows(spark, sf, root) -> None:
    """Three batches by invoice date; every ``LATE_MODULUS``-th invoice comes a batch later."""
    date = F.col("InvoiceDate")
    own = F.when(date < LATE_CUTS[0], 0).when(date < LATE_CUTS[1], 1).otherwise(2)
    slow = F.when(F.col("InvoiceNo").cast("bigint") % LATE_MODULUS == 0, 1).otherwise(0)
    for path in _invoice_parts(spark, sf, root, F.least(own + slow, F.lit(2)), 3):
        lines = C.clean_lines(N.explode_items(_invoice_stream(spark, path)))
        ST.finish(ST.start_window_table_stream(lines, f"{root}/out", f"{root}/ckpt"))


@query("stream_window_table")
def q_stream_window_table(spark, sf):
    """T4: all windows after three batches, open ones too, without the late rows."""
    root = scratch_path(spark, "stream_window_table")
    _windows_with_late_rows(spark, sf, root)
    return ST.window_table(spark, f"{root}/out")


@query("stream_window_late")
def q_stream_window_late(spark, sf):
    """T4: the rows that came after their window had closed, with the watermark they missed."""
    root = scratch_path(spark, "stream_window_late")
    _windows_with_late_rows(spark, sf, root)
    return ST.late_rows(spark, f"{root}/out").select(
        "InvoiceNo", "StockCode", "Quantity", "CustomerID", "invoice_ts", "window_end", "watermark", "batch_id")


@query("landing_compacted")
def q_landing_compacted(spark, sf):
    """K5: the lines of a landing zone after its files were compacted, twice."""
    root = scratch_path(spark, "landing_compacted")
    src = _invoice_texts(spark, sf, root)
    raw = ST.file_source(spark, src, TEXT, "text", max(1, _files(spark) // 4))
    ST.finish(ST.start_landing_stream(raw, f"{root}/zone", f"{root}/ckpt"))
    for _ in range(2):
        ST.compact_landing(spark, f"{root}/zone", f"{root}/packed")
    valid, _ = ST.landed_invoices(spark, f"{root}/packed")
    return N.explode_items(valid).select(*N.INVOICE_KEYS, "StockCode", "Description", "Quantity", "UnitPrice")


@query("stream_landing")
def q_stream_landing(spark, sf):
    root = scratch_path(spark, "stream_landing")
    src = _invoice_texts(spark, sf, root)
    raw = ST.file_source(spark, src, TEXT, "text", max(1, _files(spark) // 4))
    ST.finish(ST.start_landing_stream(raw, f"{root}/zone", f"{root}/ckpt"))
    valid, _ = ST.landed_invoices(spark, f"{root}/zone")
    return N.explode_items(valid).select(*N.INVOICE_KEYS, "StockCode", "Description",
                                         "Quantity", "UnitPrice")


@query("stream_landing_quarantine")
def q_stream_landing_quarantine(spark, sf):
    """Damaged invoices and cut-off copies of every 97th message: all of them land with
    their text, and a reason."""
    root = scratch_path(spark, "stream_landing_quarantine")
    inv = FX.invoices(spark, sf, files=_files(spark), dirty=True)
    text = inv.select("InvoiceNo", F.to_json(F.struct(*inv.columns)).alias("value"))
    cut = F.when(F.col("InvoiceNo").cast("bigint") % FX.DAMAGE_MODULUS == 5,
                 F.concat(F.left("value", F.lit(20)), F.lit(" ...")))
    msgs = text.select(F.explode(F.array_compact(F.array("value", cut))).alias("value"))
    ST.write_replay_files(msgs, f"{root}/in", None, "text")
    raw = ST.file_source(spark, f"{root}/in", TEXT, "text", max(1, _files(spark) // 2))
    ST.finish(ST.start_landing_stream(raw, f"{root}/zone", f"{root}/ckpt"))
    _, bad = ST.landed_invoices(spark, f"{root}/zone")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"),
                                     F.count(F.when(F.length("raw") > 0, 1)).alias("with_text"))


@query("stream_flat")
def q_stream_flat(spark, sf):
    """Parsed, cleaned and scored flat messages."""
    root = scratch_path(spark, "stream_flat")
    # files as the join by order left the lines, not dealt out once more as text
    lines = FX.dirty_lines(spark, sf, by_order=True, files=_files(spark))
    with shuffles_dropped(spark):
        ST.write_replay_files(lines.select(F.to_json(F.struct(*LINE_COLUMNS)).alias("value")), f"{root}/in", None, "text",
                              level="FIVE")
    raw = ST.file_source(spark, f"{root}/in", TEXT, "text")
    ST.finish(ST.start_flat_stream(raw, f"{root}/out", f"{root}/ckpt", REF_DATE))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


@query("stream_flat_quarantine")
def q_stream_flat_quarantine(spark, sf):
    """T7 in two batches: the lines that the scoring stream could not clean, with their reason
    and the invoice number that their kept message text holds."""
    root = scratch_path(spark, "stream_flat_quarantine")
    flat = FX.dirty_lines(spark, sf).select(F.to_json(F.struct(*LINE_COLUMNS)).alias("value"))
    ST.write_replay_files(flat, f"{root}/in", _files(spark), "text")
    raw = ST.file_source(spark, f"{root}/in", TEXT, "text", max(1, _files(spark) // 2))
    ST.finish(ST.start_flat_stream(raw, f"{root}/out", f"{root}/ckpt", REF_DATE))
    return ST.quarantined(spark, f"{root}/out").select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID", "InvoiceDate", "reason",
        F.get_json_object("value", "$.InvoiceNo").alias("text_invoice"))


@query("stream_leaderboard")
def q_stream_leaderboard(spark, sf):
    """Two runs of one query (restart from its checkpoint): events before the
    snapshot cut-off, then the rest; the final board diffs the two."""
    from .oracle import SNAPSHOT_CUTOFF
    root = scratch_path(spark, "stream_leaderboard")
    feed = FX.score_events(spark, sf).select(
        F.to_json(F.struct("key", "clv")).alias("value"), "ts", "event_id")
    cut = F.col("ts") < F.lit(SNAPSHOT_CUTOFF).cast("timestamp_ntz")
    for part, cond in (("a", cut), ("b", ~cut)):
        feed.filter(cond).repartition(_files(spark)).write.mode("overwrite").json(f"{root}/in/part={part}")
        raw = spark.readStream.schema(FEED).json(f"{root}/in/part=*")
        ST.finish(ST.start_leaderboard_stream(ST.rank_feed(raw), f"{root}/state", f"{root}/ckpt"))
    return ST.leaderboard(spark, f"{root}/state")


# ---- sources read back from files Spark wrote (S1, S2) ----------------------

@query("scan_nested_json")
def q_scan_nested_json(spark, sf):
    """Invoices landed as multi-line JSON-array documents, read back with
    the canonical schema and exploded to lines."""
    from ..sources.readers import read_nested_json, write_json_array_files
    root = scratch_path(spark, "scan_nested_json")
    write_json_array_files(FX.invoices(spark, sf), f"{root}/raw", rows_per_file=5_000)
    inv = read_nested_json(spark, f"{root}/raw")
    return N.explode_items(inv)


@query("scan_csv")
def q_scan_csv(spark, sf):
    """Flat lines written as CSV with a header, read back typed."""
    from ..sources.readers import read_csv_lines
    root = scratch_path(spark, "scan_csv")
    FX.invoice_lines(spark, sf).write.mode("overwrite").option("header", True).csv(f"{root}/csv")
    return read_csv_lines(spark, f"{root}/csv")


# ---- fitted models ------------------------------------------------------------

@query("fit_predict")
def q_fit_predict(spark, sf):
    """Fit the value model on the train customers (hash split), score the
    test customers."""
    from ..operators import features as FE
    from ..operators import series as SE
    from ..operators.model import fit_linear, known_features
    from .queries import TRAIN_PCT, lines
    ft = FE.features_with_target(lines(spark, sf), REF_DATE, split_date=SPLIT_DATE)
    ft = SE.hash_split(ft, "CustomerID", TRAIN_PCT)
    model = fit_linear(ft.filter(F.col("split") == "train"))
    return (model.transform(known_features(ft.filter(F.col("split") == "test")))
                 .select("CustomerID", "target_rev", F.round("prediction", 2).alias("CLV_Prediction")))


@query("fit_update")
def q_fit_update(spark, sf):
    """A model of one half of the train customers, saved, then updated by the sums of the
    other half: the coefficients are those of both halves together."""
    from ..operators import features as FE
    from ..operators import series as SE
    from ..operators.model import first_linear, update_linear
    from ..operators.moments import load_linear
    from .queries import TRAIN_PCT, lines
    ft = SE.hash_split(FE.features_with_target(lines(spark, sf), REF_DATE, split_date=SPLIT_DATE), "CustomerID", TRAIN_PCT)
    train = ft.filter(F.col("split") == "train")
    registry = scratch_path(spark, "fit_update")
    first_linear(spark, registry, train.filter(F.col("bucket") < TRAIN_PCT // 2))
    model = load_linear(spark, update_linear(spark, registry, train.filter(F.col("bucket") >= TRAIN_PCT // 2)))
    rows = [*model.coefficients.items(), ("intercept", model.intercept)]
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn("coefficient", F.round("coefficient", 6))


@query("series_forecast")
def q_series_forecast(spark, sf):
    """One-step forecast of the next invoice total from the two before
    it; scaled on the train part, fitted on train, predicted on test."""
    from ..operators import series as SE
    from ..operators.model import fit_series_model
    from .queries import _series_split
    s = _series_split(spark, sf)
    lo, hi = SE.minmax_params(s.filter(F.col("split") == "train"), "TotalValue")
    scaled = SE.minmax_scale(s, "TotalValue", lo, hi, "scaled")
    win = SE.supervised_windows(scaled, "scaled", time_step=2)
    model = fit_series_model(win.filter(F.col("split") == "train"))
    pred = model.transform(win.filter(F.col("split") == "test"))
    pred = SE.minmax_inverse(pred, "prediction", lo, hi, "predicted_value")
    pred = SE.minmax_inverse(pred, "y", lo, hi, "actual_value")
    return pred.select("split", "t", F.round("actual_value", 2).alias("actual_value"),
                       F.round("predicted_value", 2).alias("predicted_value"))
